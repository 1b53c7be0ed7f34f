"""Specs, silver tables, incremental loads, publishing and registration."""

import datetime as dt
from decimal import Decimal

import pytest
from ledgerlake import queries, specs
from ledgerlake.operators import projections, tables
from ledgerlake.operators.keyed import KeyedTable
from ledgerlake.plans import silver
from ledgerlake.sources import relational, warehouse

LOADED = dt.datetime(2024, 1, 11, 1)


def advances(spark, *rows):
    return spark.createDataFrame(
        [(pk, "1111111", dt.datetime.fromisoformat(day), Decimal(cash)) for pk, day, cash in rows],
        "PK_ADVANCE_WITHDRAW string, C_ACCOUNT_CODE string, C_APPROVE_TIME timestamp_ntz, C_CASH_VOLUME decimal(38,10)",
    )


def test_specs():
    keys = {spec.name: spec.primary_key for spec in specs.TABLES.values()}
    assert keys["fact_t_back_deal_history"] == ("PK_DEAL", "partition_date")
    assert keys["fact_v_t_erc_monthly_detail"] == ("PK_MONTHLY_DETAIL_ID", "partition_year", "partition_month")
    assert keys["dim_v_t_list_front_user"] == ("PK_FRONT_USER",)
    assert specs.FRONT_USER.partition_by == ("partition_date",)
    assert specs.BRANCH_BANK.partition_by == ()
    assert len(specs.TABLES) == 7 and len(specs.DAILY_FACTS) == 4


@pytest.mark.parametrize("spec", specs.TABLES.values(), ids=lambda spec: spec.name)
def test_every_table_goes_to_silver_and_is_published(spark, tmp_path, spec):
    added = {*spec.partition_by, "valid_from", "valid_to", "is_current"}
    source = spark.range(3).selectExpr(*(
        f"try_cast(cast(id AS string) AS {field.dataType.simpleString()}) AS {field.name}"
        for field in spec.schema.fields if field.name not in added
    ))
    path = str(tmp_path / "silver")
    silver.bronze_to_silver(source, spec, path, LOADED)
    published = silver.publish_table(warehouse.scan(spark, path), spec)
    assert published.schema.names == spec.schema.names
    assert [f.dataType for f in published.schema.fields] == [f.dataType for f in spec.schema.fields]
    assert published.count() == 3
    assert {row.valid_from for row in published.collect()} == {LOADED}


def test_publishing_refuses_missing_columns(spark):
    with pytest.raises(ValueError, match="C_CASH_VOLUME"):
        projections.publish(advances(spark).drop("C_CASH_VOLUME"), specs.ADVANCE_WITHDRAW.schema)


def test_incremental_load_takes_the_day_before(spark, tmp_path):
    spec = specs.ADVANCE_WITHDRAW
    rows = advances(
        spark, ("a", "2024-01-09T23:59:59", "1"), ("b", "2024-01-10T00:00:00", "2"),
        ("c", "2024-01-10T23:59:59", "3"), ("d", "2024-01-11T00:00:00", "4"),
    )
    tables.overwrite(rows, str(tmp_path / spec.source))
    source = relational.ParquetSource(str(tmp_path))
    loaded = {*rows.columns, "partition_date", "valid_from", "valid_to", "is_current"}
    schema = type(spec.schema)([f for f in spec.schema.fields if f.name in loaded])
    table = KeyedTable(str(tmp_path / "table"), schema, spec.primary_key, ("valid_from",), "partition_date")
    for _ in range(2):
        silver.incremental_load(spark, source, spec, table, dt.date(2024, 1, 11), LOADED)
    assert sorted(row.PK_ADVANCE_WITHDRAW for row in table.read(spark).collect()) == ["b", "c"]


def test_backfill_replaces_only_its_range(spark, tmp_path):
    spec = specs.ADVANCE_WITHDRAW
    source, path = relational.ParquetSource(str(tmp_path / "source")), str(tmp_path / "silver")
    tables.overwrite(advances(spark, ("a", "2022-05-01", "1"), ("b", "2023-05-01", "2")), f"{source.root}/{spec.source}")
    silver.source_to_silver(spark, source, spec, path, LOADED)
    tables.overwrite(advances(spark, ("a", "2022-05-01", "7"), ("b", "2023-05-01", "8")), f"{source.root}/{spec.source}")
    silver.source_to_silver(spark, source, spec, path, LOADED, dt.date(2023, 1, 1), dt.date(2024, 1, 1))
    assert {row.PK_ADVANCE_WITHDRAW: row.C_CASH_VOLUME for row in spark.read.parquet(path).collect()} == {"a": 1, "b": 8}


def test_month_partitions_stay_text(spark, tmp_path):
    detail = spark.createDataFrame([("k", Decimal(3), Decimal(2024))], "PK_MONTHLY_DETAIL_ID string, C_MONTH decimal(2,0), C_YEAR decimal(4,0)")
    path = str(tmp_path / "silver")
    silver.bronze_to_silver(detail, specs.RANKING_DETAIL, path, LOADED)
    schema = type(specs.RANKING_DETAIL.schema)([f for f in specs.RANKING_DETAIL.schema.fields if f.name in ("PK_MONTHLY_DETAIL_ID", "partition_year", "partition_month")])
    assert tuple(warehouse.scan(spark, path, schema).first()) == ("k", "2024", "3")


def test_added_columns_are_merged(spark, tmp_path):
    path = str(tmp_path / "drift")
    spark.range(1).write.parquet(path)
    spark.range(1).selectExpr("id", "'x' AS extra").write.mode("append").parquet(path)
    assert warehouse.scan(spark, path, drifted=True).columns == ["id", "extra"]


def test_truncate_keeps_the_schema(spark, tmp_path):
    path = str(tmp_path / "front")
    tables.overwrite(advances(spark, ("a", "2024-01-01", "1")), path)
    tables.truncate(spark, path)
    left = spark.read.parquet(path)
    assert left.count() == 0 and left.schema == advances(spark).schema


def test_summary_of_a_table_moves_each_key_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01", True), ("a", "2024-01-02", False), (None, "2024-01-02", True), ("b", None, None)],
                                 "PK_ADVANCE_WITHDRAW string, partition_date string, is_current boolean")
    summary = queries._silver_summary(rows, specs.ADVANCE_WITHDRAW)
    assert tuple(summary.first()) == (specs.ADVANCE_WITHDRAW.name, 4, 2, 3, "", "2024-01-02", 2)
    assert tuple(queries._silver_summary(rows.limit(0), specs.ADVANCE_WITHDRAW).first()) == (
        specs.ADVANCE_WITHDRAW.name, 0, 0, 0, None, None, 0)
    assert "Expand" not in summary._jdf.queryExecution().optimizedPlan().toString()
