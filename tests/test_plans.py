"""Physical plans: shuffles, joins, pruning and pushdown, and no Python in them."""

import datetime as dt
import re

import pytest
from ledgerlake import session, specs
from ledgerlake.operators.latest import latest_version
from ledgerlake.plans import gold, silver
from ledgerlake.queries import QUERIES
from ledgerlake.sources import bindings, relational, warehouse
from ledgerlake.streaming import cdc, ticks

LOADED = dt.datetime(2024, 2, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, operator):
    return len(re.findall(rf"\b{operator}\b", plan(df)))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def stored(spark, folder, tmp_path):
    """The four facts as stored tables."""
    names = ("margin", "debit", "advances", "deals")
    for name, fact in zip(names, bindings.facts(spark, folder), strict=True):
        fact.write.parquet(str(tmp_path / name))
    return tuple(spark.read.parquet(str(tmp_path / name)) for name in names)


def test_account_days_take_one_shuffle_and_no_join(stored, no_broadcast):
    df = gold.back_data(*stored)
    assert count(df, "Exchange") == 1
    assert "Join" not in plan(df)
    assert "partial_sum" in plan(df)


def test_joined_form_shuffles_for_every_join(stored, no_broadcast):
    df = gold.back_data_joined(*stored)
    assert count(df, "SortMergeJoin") == 3
    assert count(df, "Exchange") > 4


def test_newest_version_is_reduced_before_the_shuffle(spark, folder, no_broadcast):
    events = bindings.table(spark, folder, "events")
    df = latest_version(events, ["user_id"], ["ts", "event_id"])
    assert count(df, "Exchange") == 1
    assert "partial_max" in plan(df)


def test_day_scan_prunes_partitions(spark, folder, tmp_path):
    path = str(tmp_path / "silver")
    silver.bronze_to_silver(bindings.advance_withdraw(spark, folder), specs.ADVANCE_WITHDRAW, path, LOADED, "year")
    day = plan(warehouse.scan_day(warehouse.scan(spark, path), dt.date(1997, 5, 28)))
    assert re.search(r"PartitionFilters: \[[^\]]*partition_year", day)
    year = warehouse.scan_year(warehouse.scan(spark, path), 1997)
    assert re.search(r"PartitionFilters: \[[^\]]*partition_year", plan(year))
    files = {name for (name,) in year.selectExpr("input_file_name()").distinct().collect()}
    assert files and all("partition_year=1997" in name for name in files)


def test_gold_day_prunes_the_facts_stored_by_it(spark, tmp_path):
    path = str(tmp_path / "margin")
    spark.sql(
        "SELECT '1' AS C_ACCOUNT_CODE, timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(cast(id AS int)) AS "
        "C_TRADING_DATE, to_date(timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(cast(id AS int))) AS "
        "partition_date FROM range(3)"
    ).write.partitionBy("partition_date").parquet(path)
    day = gold.rows_of_days(spark.read.parquet(path), "C_TRADING_DATE", dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert re.search(r"PartitionFilters: \[[^\]]*partition_date", plan(day))
    assert [row.C_TRADING_DATE for row in day.collect()] == [dt.datetime(2024, 1, 2, 10)]


def test_extract_window_reaches_the_scan(spark, folder):
    source = relational.ParquetSource(folder, ".parquet")
    orders = relational.extract_full(spark, source, "orders")
    text = plan(relational.extract_day_before(orders, "o_orderdate", dt.date(1997, 5, 29)))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_columns_are_pruned(spark, folder):
    source = relational.ParquetSource(folder, ".parquet")
    text = plan(relational.extract_columns(spark, source, "customer", ["c_custkey"]))
    assert "ReadSchema: struct<c_custkey:bigint>" in text


@pytest.mark.parametrize("frame", [
    lambda spark, folder: cdc.valid_changes(bindings.deal_wire(spark, folder), specs.DEAL_FEED),
    lambda spark, folder: cdc.rejects(bindings.deal_wire(spark, folder), specs.DEAL_FEED),
    lambda spark, folder: ticks.parse_ticks(bindings.tick_wire(spark, folder)),
])
def test_text_is_parsed_once(spark, folder, frame):
    assert plan(frame(spark, folder)).count("from_json(") == 1


LAZY = ("back_data", "back_data_fullouter", "front_data", "dim_erc_ranking", "dim_back_account", "cdc_latest", "tick_parse", "market_turnover_daily")


@pytest.mark.parametrize("name", LAZY)
def test_no_python_in_plans(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert not re.search(r"Python|Pandas|CartesianProduct|NestedLoop", text)


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_folder(spark, "a") != session.new_folder(spark, "a")


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Cluster:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(Cluster())
