"""The jobs of one lake, run one after another over the test tables."""

import datetime as dt
import json
from collections import Counter
from dataclasses import replace

import pytest
from ledgerlake import jobs, specs
from ledgerlake.operators import tables
from ledgerlake.plans import gold
from ledgerlake.sources import bindings, relational
from ledgerlake.sources.streams import FileStream, KafkaStream
from pyspark.sql import functions as F

LOADED = dt.datetime(2024, 2, 1)
ADDED = ("valid_from", "valid_to", "is_current")


def widened(df, spec):
    """All declared source columns; those the test table lacks are NULL."""
    return df.select(*(
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in spec.schema.fields if f.name not in (*spec.partition_by, *ADDED)
    ))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root, folder = str(tmp_path_factory.mktemp("lake")), "/root/testdata/sf0.001"
    loaded = [*zip(jobs.FACTS, bindings.facts(spark, folder), strict=True)]
    loaded.append((specs.RANKING_DETAIL, bindings.ranking_detail(spark, folder)))
    users = spark.range(3).selectExpr("cast(id AS string) AS PK_FRONT_USER", "timestamp_ntz'2024-01-01' AS C_DATE_CREATE")
    loaded.append((specs.FRONT_USER, users))
    for spec, df in loaded:
        tables.overwrite(widened(df, spec), f"{root}/source/{spec.source}")
    tables.overwrite(bindings.back_account(spark, folder), f"{root}/source/{jobs.OPEN_DATES}")
    wires = {
        "t_back_account": bindings.account_wire, "t_front_deal": bindings.deal_wire, "ticks": bindings.tick_wire,
    }
    for name, wire in wires.items():
        wire(spark, folder).write.text(f"{root}/wire/{name}")
    return jobs.Lake(
        f"{root}/silver", f"{root}/warehouse", f"{root}/gold", f"{root}/checkpoints",
        source=relational.ParquetSource(f"{root}/source"),
        streams={name: FileStream(f"{root}/wire/{name}") for name in wires}, buckets=4,
    )


def rows(df):
    return Counter(tuple(row) for row in df.collect())


def test_daily_loads_and_gold(spark, folder, lake):
    first, end = dt.date(1997, 5, 27), dt.date(1997, 5, 29)
    for day in (first, end - dt.timedelta(days=1)):
        for spec in specs.DAILY_FACTS:
            jobs.load_increment(spark, lake, spec, day + dt.timedelta(days=1), LOADED)
    jobs.build_back_data(spark, lake, first, end)
    jobs.refresh_products(spark, lake)
    margin, debit, _, deals = bindings.facts(spark, folder)
    approved = lake.fact(specs.ADVANCE_WITHDRAW).read(spark)
    expected = gold.back_data_days(margin, debit, approved, deals, first, end)
    stored = spark.read.parquet(f"{lake.gold}/back_data").where(
        (F.col("C_DATE") >= "1997-05-27") & (F.col("C_DATE") < "1997-05-29")
    )
    key = ["C_ACCOUNT_CODE", "C_DATE", "C_RANKING_KEY", "C_KY_KPI"]
    assert rows(stored.select(key)) == rows(expected.select(key))
    assert stored.count() > 0


def test_ranking_backfill_and_month(spark, folder, lake):
    spec = specs.RANKING_DETAIL
    jobs.load_silver(spark, lake, spec, LOADED)
    jobs.publish_silver(spark, lake, spec)
    jobs.build_ranking(spark, lake)
    jobs.build_ranking(spark, lake, dt.date(1998, 1, 15))
    expected = gold.erc_ranking(bindings.ranking_detail(spark, folder))
    assert rows(spark.read.parquet(f"{lake.gold}/dim_erc_ranking").select(*expected.columns)) == rows(expected)


def test_dimension_is_upserted(spark, lake):
    """A partial reload adds and replaces rows; it loses none."""
    spec = specs.FRONT_USER
    jobs.load_silver(spark, lake, spec, LOADED)
    jobs.publish_silver(spark, lake, spec)
    users = spark.range(2, 5).selectExpr("cast(id AS string) AS PK_FRONT_USER", "timestamp_ntz'2024-03-01' AS C_DATE_CREATE")
    tables.overwrite(widened(users, spec), f"{lake.silver}/part/{spec.source}")
    part = replace(lake, source=relational.ParquetSource(f"{lake.silver}/part"), database="registered_silver")
    jobs.load_silver(spark, part, spec, LOADED + dt.timedelta(days=1))
    jobs.publish_silver(spark, part, spec)
    stored = lake.fact(spec).read(spark)
    assert stored.columns == spec.schema.names
    assert {(row.PK_FRONT_USER, row.C_DATE_CREATE.month) for row in stored.collect()} == {("0", 1), ("1", 1), ("2", 3), ("3", 3), ("4", 3)}
    assert spark.table(f"registered_silver.{spec.name}").count() == 3
    loads = spark.read.parquet(f"{lake.silver}/loads").where(F.col("table_name") == spec.name)
    assert sorted(row.row_count for row in loads.collect()) == [3, 3]


def test_feeds(spark, lake):
    for feed in jobs.FEEDS.values():
        jobs.run_change_log(spark, lake, feed)
        jobs.run_state(spark, lake, feed)
        jobs.run_rejects(spark, lake, feed)
    assert spark.read.text(f"{lake.silver}/t_front_deal_rejects").count() == 0
    columns = ["PK_FRONT_DEAL", "C_ACCOUNT_CODE", "C_MATCHED_PRICE", "ts_ms"]
    from_log = jobs.deals_of_change_log(spark, lake).select(columns)
    assert rows(lake.state(specs.DEAL_FEED).read(spark).select(columns)) == rows(from_log)
    jobs.build_account_dim(spark, lake)
    jobs.build_open_dates(spark, lake)
    dimension = spark.read.parquet(f"{lake.gold}/dim_back_account")
    assert dimension.count() == lake.state(specs.ACCOUNT_FEED).read(spark).count() > 0
    assert spark.read.parquet(f"{lake.gold}/mv_t_back_account").count() > 0
    jobs.build_front_data(spark, lake, dt.date(2024, 1, 15))
    whole = rows(spark.read.parquet(f"{lake.gold}/front_data"))
    assert whole
    jobs.run_day_state(spark, lake)
    jobs.refresh_products(spark, lake, dt.date(2024, 1, 15))
    assert rows(spark.read.parquet(f"{lake.gold}/front_data")) == whole
    incremental = lake.account_dim().read(spark).select(*dimension.columns)
    assert rows(incremental) == rows(dimension)
    jobs.compact_log(spark, lake, specs.DEAL_FEED, dt.date(2024, 1, 20))
    assert rows(jobs.deals_of_change_log(spark, lake).select(columns)) == rows(from_log)
    jobs.fold_tables(spark, lake, least=1)
    jobs.expire_tables(spark, lake)
    assert rows(lake.state(specs.DEAL_FEED).read(spark).select(columns)) == rows(from_log)


def test_turnover(spark, lake):
    jobs.run_ticks(spark, lake)
    jobs.run_turnover(spark, lake)
    jobs.build_turnover(spark, lake, dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    closed = {row.C_DATE: row.total_market_value for row in spark.read.parquet(f"{lake.gold}/market_data_closed").collect()}
    whole = {row.C_DATE: row.total_market_value for row in spark.read.parquet(f"{lake.gold}/market_data").collect()}
    assert closed and closed.items() <= whole.items() and len(whole) == len(closed) + 1


def test_config(tmp_path):
    config = {
        "silver": "s", "warehouse": "w/", "gold": "g", "checkpoints": "c", "buckets": 8,
        "jdbc": {"url": "jdbc:none", "user": "u"}, "split": {"T": ["a = 1"]},
        "kafka": {"ticks": {"servers": "host:1", "assign": '{"t": [0]}', "text": False}},
    }
    lake = jobs.lake_of(json.loads(json.dumps(config)))
    assert (lake.warehouse, lake.buckets, lake.source.split["T"]) == ("w", 8, ["a = 1"])
    assert all(len(lake.source.split[spec.source]) == jobs.READS for spec in specs.TABLES.values())
    assert lake.streams["ticks"] == KafkaStream("host:1", assign='{"t": [0]}', text=False)


def test_jobs_refuse_tables_they_cannot_load(spark, lake):
    with pytest.raises(ValueError, match="days or months"):
        jobs.load_increment(spark, lake, specs.BRANCH_BANK, dt.date(2024, 1, 2), LOADED)
    with pytest.raises(ValueError, match="no business date"):
        jobs.load_silver(spark, lake, specs.RANKING_DETAIL, LOADED, dt.date(2024, 1, 1), dt.date(2024, 2, 1))
