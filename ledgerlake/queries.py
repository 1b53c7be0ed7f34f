"""Registered queries: every operator over the whole supplied tables. Each takes a session and a table folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ledgerlake import schemas, specs
from ledgerlake.functions import labels
from ledgerlake.functions.times import local_from_millis, utc_from_millis
from ledgerlake.operators import latest, projections, reports, tables
from ledgerlake.operators.dayindex import DayIndex
from ledgerlake.operators.keyed import KeyedTable
from ledgerlake.plans import gold, silver
from ledgerlake.session import new_folder
from ledgerlake.sources import bindings, relational, warehouse
from ledgerlake.sources.streams import FileStream
from ledgerlake.streaming import cdc, refresh, sums, ticks
from ledgerlake.streaming.compaction import CompactedLog

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

LOADED = dt.datetime(2024, 2, 1, 1, 0)
RELOADED = dt.datetime(2024, 2, 2, 1, 0)
BUCKETS = 8
TRADES = specs.DEAL_FEED.only("C_ACCOUNT_CODE", "C_MATCHED_PRICE", "C_MATCHED_VOLUME")
GOLD_TYPES = {
    "C_MARGIN_DEBT": "decimal(38,4)", "C_MBLINK_DEBT": "decimal(38,2)",
    "C_UTTB": "decimal(38,2)", "C_GTGD": "decimal(38,4)",
}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _typed(df: DataFrame) -> DataFrame:
    """Measures with one explicit type each, the same as in the SQL."""
    return projections.cast_columns(df, GOLD_TYPES)


def _parquet(folder: str) -> relational.ParquetSource:
    return relational.ParquetSource(folder, ".parquet")


def _declared(spec: specs.TableSpec, df: DataFrame) -> StructType:
    """Declared columns that the test table has, with the load columns."""
    loaded = {*df.columns, *spec.partition_by, "valid_from", "valid_to", "is_current"}
    return StructType([field for field in spec.schema.fields if field.name in loaded])


# --- sources ---


@register
def extract_full(spark: SparkSession, folder: str) -> DataFrame:
    return relational.extract_full(spark, _parquet(folder), "orders")


@register
def extract_projection(spark: SparkSession, folder: str) -> DataFrame:
    return relational.extract_columns(spark, _parquet(folder), "customer", ["c_custkey", "c_mktsegment"])


@register
def extract_year(spark: SparkSession, folder: str) -> DataFrame:
    return relational.extract_year(bindings.deal_history(spark, folder), "C_TRANSACTION_DATE", 1997)


@register
def extract_daily_window(spark: SparkSession, folder: str) -> DataFrame:
    return relational.extract_day_before(
        bindings.deal_history(spark, folder), "C_TRANSACTION_DATE", dt.date(1997, 5, 29)
    )


@register
def extract_prev_month(spark: SparkSession, folder: str) -> DataFrame:
    return relational.extract_previous_month(bindings.ranking_detail(spark, folder), dt.date(1998, 1, 15))


def _stored_advances(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "advances")
    silver.bronze_to_silver(
        bindings.advance_withdraw(spark, folder), specs.ADVANCE_WITHDRAW, path, LOADED, grain="month"
    )
    return warehouse.scan(spark, path)


ADVANCE_COLUMNS = ("PK_ADVANCE_WITHDRAW", "C_ACCOUNT_CODE", "C_APPROVE_TIME", "C_CASH_VOLUME", "partition_date")


@register
def scan_partition_day(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored_advances(spark, folder)
    return warehouse.scan_day(stored, dt.date(1997, 5, 28)).select(*ADVANCE_COLUMNS)


@register
def scan_partition_year(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.scan_year(_stored_advances(spark, folder), 1998).select(*ADVANCE_COLUMNS)


# --- projections ---


@register
def add_lineage(spark: SparkSession, folder: str) -> DataFrame:
    customers = bindings.table(spark, folder, "customer").select("c_custkey", "c_name")
    loaded = customers.withColumns(projections.lineage_columns(LOADED))
    return loaded.withColumn("valid_to", F.col("valid_to").isNull()).withColumnRenamed("valid_to", "open_ended")


@register
def cast_decimals(spark: SparkSession, folder: str) -> DataFrame:
    return projections.cast_columns(bindings.deal_history(spark, folder), specs.DEAL_DECIMALS).select(
        "PK_DEAL", "C_MATCHED_PRICE", "C_MATCHED_VOLUME"
    )


@register
def fn_calendar(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate")
    return bindings.table(spark, folder, "orders").select(
        "o_orderkey", F.year(day).alias("C_YEAR"), F.month(day).alias("C_MONTH"), F.to_date(day).alias("C_DATE"),
        F.date_format(day, "yyyy-MM-dd").alias("partition_text"),
    )


@register
def fn_origin_account(spark: SparkSession, folder: str) -> DataFrame:
    full, short = bindings.account_code("c_custkey"), F.col("c_custkey").cast("string")
    return bindings.table(spark, folder, "customer").select(
        "c_custkey", labels.origin_account(full).alias("origin"), labels.origin_account(short).alias("short_origin")
    )


@register
def fn_ranking_key(spark: SparkSession, folder: str) -> DataFrame:
    origin = labels.origin_account(bindings.account_code("o_custkey"))
    return bindings.table(spark, folder, "orders").select(
        "o_orderkey",
        labels.ranking_key(origin, F.year("o_orderdate"), F.month("o_orderdate")).alias("C_RANKING_KEY"),
    )


@register
def fn_kpi_period(spark: SparkSession, folder: str) -> DataFrame:
    return bindings.table(spark, folder, "orders").select(
        "o_orderkey", labels.kpi_period(F.year("o_orderdate"), F.month("o_orderdate")).alias("C_KY_KPI")
    )


@register
def fn_month_shift(spark: SparkSession, folder: str) -> DataFrame:
    year, month = labels.effective_month(F.year("o_orderdate"), F.month("o_orderdate"))
    return bindings.table(spark, folder, "orders").select(
        "o_orderkey", year.alias("C_YEAR_ADJ"), month.alias("C_MONTH_ADJ")
    )


@register
def fn_epoch_local(spark: SparkSession, folder: str) -> DataFrame:
    changes = cdc.valid_changes(bindings.deal_wire(spark, folder), specs.DEAL_FEED)
    millis = F.col("ts_ms")
    return changes.select(
        F.col("scn").cast("bigint").alias("event_id"), utc_from_millis(millis).alias("utc_time"),
        local_from_millis(millis).alias("local_time"),
    )


@register
def shift_timezone_columns(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "shift")
    events = bindings.table(spark, folder, "events").select(
        "event_id", F.col("ts").alias("updated_at"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("created_at")
    )
    tables.overwrite(events, f"{path}/version=1")
    utc = warehouse.scan(spark, f"{path}/version=1")
    tables.overwrite(projections.shift_to_local(utc, ["updated_at", "created_at"]), f"{path}/version=2")
    return warehouse.scan(spark, f"{path}/version=2")


# --- writes ---


@register
def bronze_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "bronze")
    for _ in range(2):
        tables.overwrite(bindings.table(spark, folder, "orders"), path)
    return warehouse.scan(spark, path)


@register
def backfill_dynamic_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "backfill")
    deals = bindings.deal_history(spark, folder).select(
        "PK_DEAL", "C_TRANSACTION_DATE", "C_MATCHED_PRICE", F.year("C_TRANSACTION_DATE").alias("partition_year")
    )
    tables.overwrite_partitions(deals, path, ["partition_year"])
    corrected = relational.extract_year(deals, "C_TRANSACTION_DATE", 1997).withColumn(
        "C_MATCHED_PRICE", (F.col("C_MATCHED_PRICE") * 2).cast("decimal(15,2)")
    )
    tables.overwrite_partitions(corrected, path, ["partition_year"])
    return warehouse.scan(spark, path)


def _silver_deals(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "silver")
    silver.bronze_to_silver(bindings.deal_history(spark, folder), specs.DEAL_HISTORY, path, LOADED, grain="year")
    return path


@register
def bronze_to_silver(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.scan(spark, _silver_deals(spark, folder)).drop("valid_to")


@register
def bronze_to_silver_days(spark: SparkSession, folder: str) -> DataFrame:
    """Silver stored by day, the layout of all daily tables, rewritten by a second run."""
    path = new_folder(spark, "silver-days")
    for _ in range(2):
        silver.bronze_to_silver(bindings.front_user(spark, folder), specs.FRONT_USER, path, LOADED)
    return warehouse.scan(spark, path).drop("valid_to", "is_current")


def _silver_summary(stored: DataFrame, spec: specs.TableSpec) -> DataFrame:
    """What a silver table holds: rows, keys and partitions."""
    part = F.concat_ws("/", *(F.col(name).cast("string") for name in spec.partition_by)) if spec.partition_by else F.lit("")
    # Partitions are counted first, of which there are few; keys by themselves, so that nothing is sorted or moved twice.
    parts = stored.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), F.count_if("is_current").alias("current_rows"))
    keys = stored.select(F.col(spec.key).alias("key")).distinct().agg(F.count("key").alias("keys"))
    return parts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("part").alias("partitions"), F.min("part").alias("first_partition"),
        F.max("part").alias("last_partition"), F.coalesce(F.sum("current_rows"), F.lit(0)).alias("current_rows"),
    ).crossJoin(keys).select(
        F.lit(spec.name).alias("table_name"), "rows", "keys", "partitions", "first_partition", "last_partition", "current_rows")


@register
def bronze_to_silver_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Each of the seven tables from its bronze copy to silver."""
    path, found = new_folder(spark, "bronze-silver"), []
    for name, rows in bindings.sources(spark, folder).items():
        spec = specs.TABLES[name]
        tables.overwrite(rows, f"{path}/bronze/{name}")
        grain = "year" if spec.date_column else None
        silver.bronze_to_silver(warehouse.scan(spark, f"{path}/bronze/{name}"), spec, f"{path}/silver/{name}", LOADED, grain)
        found.append(_silver_summary(warehouse.scan(spark, f"{path}/silver/{name}"), spec))
    return reduce(DataFrame.unionByName, found)


@register
def source_to_silver_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Each of the seven tables from its source to silver: the daily facts as a backfill of two months, the others whole. The
    backfill runs twice and replaces its days."""
    path, found = new_folder(spark, "source-silver"), []
    source = relational.ParquetSource(f"{path}/source")
    for name, rows in bindings.sources(spark, folder).items():
        spec = specs.TABLES[name]
        tables.overwrite(rows, f"{path}/source/{spec.source}")
        window = (dt.date(1997, 4, 1), dt.date(1997, 6, 1)) if spec in specs.DAILY_FACTS else (None, None)
        for _ in range(2 if spec in specs.DAILY_FACTS else 1):
            silver.source_to_silver(spark, source, spec, f"{path}/silver/{name}", LOADED, *window)
        found.append(_silver_summary(warehouse.scan(spark, f"{path}/silver/{name}"), spec))
    return reduce(DataFrame.unionByName, found)


@register
def publish_select(spark: SparkSession, folder: str) -> DataFrame:
    stored = warehouse.scan(spark, _silver_deals(spark, folder))
    target = _declared(specs.DEAL_HISTORY, bindings.deal_history(spark, folder))
    return projections.publish(stored, target).drop("valid_to")


@register
def silver_ranking_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """The whole detail loaded once, then the month before ``as_of`` loaded again by the monthly job."""
    path = new_folder(spark, "ranking")
    detail = bindings.ranking_detail(spark, folder)
    spec = specs.RANKING_DETAIL
    schema = _declared(spec, detail)
    table = KeyedTable(f"{path}/table", schema, spec.primary_key, ("valid_from",), spec.partition_by)
    tables.overwrite(detail, f"{path}/source/{spec.source}")
    source = relational.ParquetSource(f"{path}/source")
    full = silver.to_silver(source.table(spark, spec.source), spec, LOADED)
    table.upsert(projections.publish(full, schema))
    silver.incremental_load(spark, source, spec, table, dt.date(1998, 1, 15), RELOADED)
    return table.read(spark).drop("valid_to", "is_current")


@register
def register_external(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "external")
    tables.overwrite(bindings.table(spark, folder, "supplier"), f"{path}/supplier")
    database = f"silver_{path.rsplit('-', 1)[1][:12]}"
    name = f"{database}.dim_supplier"
    for _ in range(2):
        tables.register_external(spark, name, f"{path}/supplier", location=f"{path}/database")
    return spark.sql(f"SELECT * FROM {name}")


@register
def register_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """A partitioned table, registered after its first load and told of the partitions of a second one."""
    path = new_folder(spark, "partitioned")
    name = f"silver_{path.rsplit('-', 1)[1][:12]}.orders"
    orders = bindings.table(spark, folder, "orders").withColumn("partition_year", F.year("o_orderdate"))
    first = F.col("partition_year") < 1996
    tables.append(orders.where(first), f"{path}/orders", ["partition_year"])
    tables.register_external(spark, name, f"{path}/orders", location=f"{path}/database")
    tables.append(orders.where(~first), f"{path}/orders", ["partition_year"])
    tables.refresh_partitions(spark, name)
    return spark.sql(f"SELECT o_orderkey, o_custkey, partition_year FROM {name}")


@register
def append_managed_table(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "managed")
    database = f"bronze_{path.rsplit('-', 1)[1][:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    loads = {
        "2024-01-01": bindings.table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), "c_name"),
        "2024-01-02": bindings.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), "s_name"),
    }
    for day, rows in loads.items():
        rows = rows.toDF("id", "name").withColumn("partition_date", F.lit(day))
        tables.append_managed(rows, f"{database}.party_raw", ["partition_date"])
    return spark.table(f"{database}.party_raw")


@register
def upsert_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """A full load, a reload of corrected rows, and the first load again, which is older and loses."""
    advances = bindings.advance_withdraw(spark, folder)
    spec = specs.ADVANCE_WITHDRAW
    schema = StructType([*_declared(spec, advances).fields, StructField("partition_year", DateType())])
    table = KeyedTable(new_folder(spark, "upsert"), schema, spec.primary_key, ("valid_from",), "partition_year")

    def load(rows: DataFrame, loaded_at: dt.datetime) -> None:
        loaded = silver.to_silver(rows, spec, loaded_at).withColumn("partition_year", F.trunc("partition_date", "year"))
        table.upsert(projections.publish(loaded, schema))

    load(advances, LOADED)
    corrected = advances.where("C_APPROVE_TIME >= '2000-01-01'").withColumn("C_CASH_VOLUME", F.col("C_CASH_VOLUME") + 1)
    load(corrected, RELOADED)
    load(advances, LOADED)
    return table.read(spark).drop("valid_to", "is_current")


def _keyed_fact(rows: DataFrame, spec: specs.TableSpec, path: str, grain: str = "year") -> tuple[KeyedTable, DataFrame]:
    """A keyed table for ``rows`` as loaded, stored by month or year, and the loaded rows."""
    loaded = _as_loaded(rows, spec, LOADED, grain)
    return KeyedTable(path, loaded.schema, spec.primary_key, ("valid_from",), f"partition_{grain}"), loaded


def _as_loaded(rows: DataFrame, spec: specs.TableSpec, loaded_at: dt.datetime, grain: str = "year") -> DataFrame:
    loaded = silver.to_silver(rows, spec, loaded_at).drop("valid_to", "is_current")
    return loaded.withColumn(f"partition_{grain}", F.trunc("partition_date", grain))


@register
def upsert_partial_touch(spark: SparkSession, folder: str) -> DataFrame:
    """A full load, then corrections of one year, announced, which rewrite that year alone."""
    advances = bindings.advance_withdraw(spark, folder)
    table, loaded = _keyed_fact(advances, specs.ADVANCE_WITHDRAW, new_folder(spark, "touch"))
    table.upsert(loaded)
    corrected = relational.extract_year(advances, "C_APPROVE_TIME", 1997).withColumn(
        "C_CASH_VOLUME", (F.col("C_CASH_VOLUME") + 1).cast("decimal(15,2)"))
    table.upsert(_as_loaded(corrected, specs.ADVANCE_WITHDRAW, RELOADED), ["1997-01-01"])
    return table.read(spark).drop("valid_from")


@register
def update_rows_by_predicate(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "update")
    orders = bindings.table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("partition_year"))
    tables.overwrite(orders, path, ["partition_year"])
    pending = (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0)
    tables.update_where(spark, path, ["partition_year"], pending, {"o_orderpriority": F.lit("REVISED")})
    return warehouse.scan(spark, path)


@register
def incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    """Three daily loads of the deal history, one of them run twice."""
    deals = bindings.deal_history(spark, folder)
    spec = specs.DEAL_HISTORY
    path = new_folder(spark, "incremental")
    tables.overwrite(deals, f"{path}/source/{spec.source}")
    source = relational.ParquetSource(f"{path}/source")
    table = KeyedTable(
        f"{path}/table", _declared(spec, deals), spec.primary_key, ("valid_from",), "partition_date"
    )
    for day in (27, 28, 29, 28):
        silver.incremental_load(spark, source, spec, table, dt.date(1997, 5, day), LOADED)
    return table.read(spark).drop("valid_to")


@register
def incremental_load_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Two daily loads of each of the four facts, the second one repeated."""
    path, found = new_folder(spark, "daily"), []
    source, rows = relational.ParquetSource(f"{path}/source"), bindings.sources(spark, folder)
    for spec in specs.DAILY_FACTS:
        tables.overwrite(rows[spec.name], f"{path}/source/{spec.source}")
        table = KeyedTable(
            f"{path}/{spec.name}", _declared(spec, rows[spec.name]), spec.primary_key, ("valid_from",), "partition_date")
        for day in (28, 29, 29):
            silver.incremental_load(spark, source, spec, table, dt.date(1997, 5, day), LOADED)
        found.append(table.read(spark).select(
            F.lit(spec.name).alias("table_name"), F.col(spec.key).alias("key"), "C_ACCOUNT_CODE", "partition_date"))
    return reduce(DataFrame.unionByName, found)


@register
def truncate_table(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "truncate")
    tables.overwrite(front_data(spark, folder), path)
    before = warehouse.scan(spark, path).count()
    tables.truncate(spark, path)
    return warehouse.scan(spark, path).agg(
        F.lit(before).cast("bigint").alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    )


@register
def load_report(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "report")
    names = ("margin_balance", "debit_balance", "advance_withdraw", "deal_history")
    counts = {
        name: reports.write_counted(rows, lambda df, name=name: tables.overwrite(df, f"{path}/{name}"))
        for name, rows in zip(names, bindings.facts(spark, folder), strict=True)
    }
    return reports.load_report(spark, counts)


# --- aggregates and gold ---


@register
def agg_margin_debt(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(gold.margin_debt(bindings.margin_balance(spark, folder)))


@register
def agg_mblink_debt(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(gold.mblink_debt(bindings.debit_balance(spark, folder)))


@register
def agg_advance_withdraw(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(gold.advance_withdraw(bindings.advance_withdraw(spark, folder)))


@register
def agg_traded_value(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(gold.traded_value(bindings.deal_history(spark, folder)))


@register
def full_outer_two(spark: SparkSession, folder: str) -> DataFrame:
    margin = gold.margin_debt(bindings.margin_balance(spark, folder)).select(*gold.ACCOUNT_DAY, "C_MARGIN_DEBT")
    debit = gold.mblink_debt(bindings.debit_balance(spark, folder)).select(*gold.ACCOUNT_DAY, "C_MBLINK_DEBT")
    return _typed(gold.full_outer(margin, debit))


@register
def back_data(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(gold.back_data(*bindings.facts(spark, folder)))


FACTS = (specs.MARGIN_BALANCE, specs.DEBIT_BALANCE, specs.ADVANCE_WITHDRAW, specs.DEAL_HISTORY)


def _keyed_facts(spark: SparkSession, folder: str, path: str) -> dict[str, KeyedTable]:
    """The four facts in keyed tables, as jobs store them. Some test order lines share their numbers, so their key gets the
    other columns as well."""
    out = {}
    for name, spec, rows in zip(refresh.BUSINESS_DATES, FACTS, bindings.facts(spark, folder), strict=True):
        if spec is not specs.ADVANCE_WITHDRAW:
            rows = rows.withColumn(spec.key, F.concat_ws("|", *(F.col(column).cast("string") for column in rows.columns)))
        out[name], loaded = _keyed_fact(rows, spec, f"{path}/{name}")
        out[name].upsert(loaded, gathered=True)  # stored by year
    return out


@register
def back_data_four_tables(spark: SparkSession, folder: str) -> DataFrame:
    """From four stored tables."""
    stored = _keyed_facts(spark, folder, new_folder(spark, "facts"))
    return _typed(gold.back_data(*(table.read(spark) for table in stored.values())))


@register
def back_data_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """A month of withdraw days from advances stored by approval month; the index names the partitions that are read."""
    path = new_folder(spark, "indexed")
    margin, debit, advances, deals = bindings.facts(spark, folder)
    table, loaded = _keyed_fact(advances, specs.ADVANCE_WITHDRAW, f"{path}/table", "month")
    index = DayIndex(f"{path}/days", "C_WITHDRAW_DATE", "partition_month")
    index.add(loaded)
    table.upsert(loaded)
    first, end = dt.date(1997, 5, 1), dt.date(1997, 6, 1)
    stored = table.read(spark, index.parts(spark, first, end))
    return _typed(gold.back_data_days(margin, debit, stored, deals, first, end))


@register
def back_data_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of which some have lost their account and others their date."""
    dates = [*refresh.BUSINESS_DATES.values()]
    facts = [
        rows.withColumn(date, F.when(~F.col("C_ACCOUNT_CODE").endswith("3"), F.col(date))).withColumn(
            "C_ACCOUNT_CODE", F.when(~F.col("C_ACCOUNT_CODE").endswith("7"), F.col("C_ACCOUNT_CODE")))
        for rows, date in zip(bindings.facts(spark, folder), dates, strict=True)
    ]
    return gold.back_data_rejects(*facts)


@register
def back_data_fullouter(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(gold.back_data_joined(*bindings.facts(spark, folder)))


@register
def back_data_daily(spark: SparkSession, folder: str) -> DataFrame:
    day = dt.date(1997, 5, 28)
    return _typed(gold.back_data_days(*bindings.facts(spark, folder), day, day + dt.timedelta(days=1)))


def _accounts(spark: SparkSession, folder: str) -> DataFrame:
    feed = specs.ACCOUNT_FEED.only("C_ACCOUNT_CODE", "C_ACCOUNT_BRANCH_CODE", "C_CHANNEL", "C_OPEN_DATE")
    changes = cdc.valid_changes(bindings.account_wire(spark, folder), feed).drop("created")
    return latest.current_state(changes, ["PK_ACCOUNT"], specs.VERSION_ORDER, F.col("op") == specs.DELETE)


@register
def back_data_known_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return gold.known_accounts(back_data(spark, folder), _accounts(spark, folder))


@register
def front_data(spark: SparkSession, folder: str) -> DataFrame:
    log = cdc.change_log(cdc.valid_changes(bindings.deal_wire(spark, folder), TRADES), TRADES)
    return _typed(gold.front_data(log, dt.date(2024, 1, 15)))


@register
def front_data_current(spark: SparkSession, folder: str) -> DataFrame:
    """The same measures over all current deals, dated ``as_of``."""
    changes = cdc.valid_changes(bindings.deal_wire(spark, folder), TRADES).drop("created")
    deals = latest.current_state(changes, ["PK_FRONT_DEAL"], specs.VERSION_ORDER, F.col("op") == specs.DELETE)
    return _typed(gold.front_data_of(deals, dt.date(2024, 1, 15)))


@register
def dim_erc_ranking(spark: SparkSession, folder: str) -> DataFrame:
    detail = warehouse.as_view(bindings.ranking_detail(spark, folder), "ranking_detail")
    return gold.erc_ranking(detail)


@register
def dim_erc_ranking_monthly(spark: SparkSession, folder: str) -> DataFrame:
    detail = relational.extract_previous_month(bindings.ranking_detail(spark, folder), dt.date(1998, 1, 15))
    return gold.erc_ranking(detail)


@register
def erc_ranking_known_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return gold.erc_ranking_of_known(bindings.ranking_detail(spark, folder), _accounts(spark, folder))


@register
def dim_back_account(spark: SparkSession, folder: str) -> DataFrame:
    return gold.back_account_dim(bindings.back_account(spark, folder))


@register
def mv_back_account(spark: SparkSession, folder: str) -> DataFrame:
    open_dates = bindings.back_account(spark, folder).select("C_ACCOUNT_CODE", "C_OPEN_DATE")
    return gold.account_open_dates(_accounts(spark, folder), open_dates)


@register
def last_tick_per_day(spark: SparkSession, folder: str) -> DataFrame:
    return gold.last_tick_per_day(bindings.index_tick(spark, folder))


@register
def market_turnover_daily(spark: SparkSession, folder: str) -> DataFrame:
    return gold.market_turnover(bindings.index_tick(spark, folder)).orderBy("C_DATE")


@register
def refresh_touched_days(spark: SparkSession, folder: str) -> DataFrame:
    """Gold without the advances approved from 2000 on; then those arrive and only the touched years are redone."""
    path = new_folder(spark, "gold")
    margin, debit, advances, deals = bindings.facts(spark, folder)
    late = F.col("C_APPROVE_TIME") >= "2000-01-01"
    gold.write_account_days(gold.back_data(margin, debit, advances.where(~late), deals), path, "year")
    touched = refresh.touched_periods(advances.where(late), "C_WITHDRAW_DATE", "year")
    refresh.refresh_account_days(margin, debit, advances, deals, path, touched, "year")
    return warehouse.scan(spark, path).drop("partition_year")


@register
def refresh_moved_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Account-days by day; then advances of one month turn out to be of other days, and the days they have left and those they
    have come to are recomputed."""
    path = new_folder(spark, "moved")
    facts = _keyed_facts(spark, folder, path)
    product = refresh.account_days_product(facts, f"{path}/gold")
    refresh.refresh_product(spark, product, f"{path}/seen")
    advances = bindings.advance_withdraw(spark, folder)
    later = F.make_dt_interval((F.col("PK_ADVANCE_WITHDRAW").cast("int") % 3 * 20).cast("int"))
    moved = advances.where("C_WITHDRAW_DATE >= '1997-05-01' AND C_WITHDRAW_DATE < '1997-06-01'").withColumn(
        "C_WITHDRAW_DATE", (F.col("C_WITHDRAW_DATE") + later).cast(advances.schema["C_WITHDRAW_DATE"].dataType))
    facts["advances"].append_delta(_as_loaded(moved, specs.ADVANCE_WITHDRAW, RELOADED))
    for _ in range(2):
        refresh.refresh_product(spark, product, f"{path}/seen")
    return warehouse.scan(spark, f"{path}/gold").drop("partition_day")


@register
def refresh_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """All rankings; then the detail of two months is corrected and only what these give is replaced."""
    path, spec = new_folder(spark, "ranking"), specs.RANKING_DETAIL
    detail = bindings.ranking_detail(spark, folder)

    def loaded(rows: DataFrame, loaded_at: dt.datetime) -> DataFrame:
        return silver.to_silver(rows, spec, loaded_at).drop("valid_to", "is_current")

    table = KeyedTable(f"{path}/detail", loaded(detail, LOADED).schema, spec.primary_key, ("valid_from",), spec.partition_by)
    product = refresh.ranking_product(table, f"{path}/gold")
    table.upsert(loaded(detail, LOADED))
    refresh.refresh_product(spark, product, f"{path}/seen")
    corrected = detail.where("C_YEAR = 1997 AND C_MONTH IN (3, 12)").withColumn(
        "C_SYNTHETIC_ANNOUCED_RANKING", F.lit("REVISED"))
    table.upsert(loaded(corrected, RELOADED), ["1997/3", "1997/12"])
    refresh.refresh_product(spark, product, f"{path}/seen")
    return warehouse.scan(spark, f"{path}/gold")


# --- change feeds and ticks ---


@register
def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    events = bindings.table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return latest.latest_version(events, ["user_id"], ["ts", "event_id"])


@register
def cdc_parse(spark: SparkSession, folder: str) -> DataFrame:
    return cdc.valid_changes(bindings.deal_wire(spark, folder), TRADES).select(
        "PK_FRONT_DEAL", "op", "ts_ms", F.col("scn").cast("bigint").alias("scn"), "C_ACCOUNT_CODE",
        "C_MATCHED_PRICE", "C_MATCHED_VOLUME",
    )


@register
def cdc_plain_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Plain JSON rows mixed with text that is no row; the latter has no key and is left out."""
    events = bindings.table(spark, folder, "events")
    row = F.struct(
        F.col("event_id").cast("double").alias("PK_FRONT_DEAL"), F.col("value").alias("C_MATCHED_PRICE")
    )
    lines = events.select(F.to_json(row).alias("value")).union(events.select("event_type"))
    return cdc.parse_rows(lines, specs.DEAL_FEED).where("PK_FRONT_DEAL IS NOT NULL").select(
        "PK_FRONT_DEAL", "C_MATCHED_PRICE"
    )


@register
def cdc_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Change records mixed with JSON that is none; the latter comes out as text."""
    others = bindings.table(spark, folder, "events").select(F.col("props").alias("value"))
    return cdc.rejects(bindings.deal_wire(spark, folder).union(others), specs.DEAL_FEED)


@register
def cdc_latest(spark: SparkSession, folder: str) -> DataFrame:
    return _accounts(spark, folder).select(
        "PK_ACCOUNT", "op", "ts_ms", F.col("scn").cast("bigint").alias("scn"), "C_ACCOUNT_CODE",
        "C_ACCOUNT_BRANCH_CODE", "C_CHANNEL",
    )


@register
def cdc_change_log(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "log")
    bindings.account_wire(spark, folder).write.text(f"{path}/wire")
    cdc.start_change_log(
        spark, FileStream(f"{path}/wire"), specs.ACCOUNT_FEED, f"{path}/log", f"{path}/checkpoint"
    ).awaitTermination()
    return warehouse.scan(spark, f"{path}/log").select(
        "PK_ACCOUNT", "created_at", "updated_at", "op", "C_ACCOUNT_CODE", "C_CHANNEL", "partition_date", "ts_ms",
        F.col("scn").cast("bigint").alias("scn"),
    )


def _deal_state(table: KeyedTable, spark: SparkSession) -> DataFrame:
    return table.read(spark).select(
        "PK_FRONT_DEAL", "C_ACCOUNT_CODE", "C_MATCHED_PRICE", "C_MATCHED_VOLUME", "__op", "ts_ms"
    )


@register
def cdc_apply_changes(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "state")
    bindings.deal_wire(spark, folder).write.text(f"{path}/wire")
    table = cdc.state_table(f"{path}/table", specs.DEAL_FEED)
    cdc.start_apply_changes(
        spark, FileStream(f"{path}/wire"), specs.DEAL_FEED, table, f"{path}/checkpoint", BUCKETS
    ).awaitTermination()
    return _deal_state(table, spark)


@register
def cdc_apply_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Several batches, each a delta of the state, some of them folded in between and all at the end."""
    path = new_folder(spark, "deltas")
    feed, table = specs.DEAL_FEED, cdc.state_table(f"{path}/table", specs.DEAL_FEED)
    changes = cdc.valid_changes(bindings.deal_wire(spark, folder), feed)
    for number, part in enumerate((3, 1, 0, 2, 1)):
        cdc.apply_changes(changes.where(F.col("scn") % 4 == part), feed, table, BUCKETS, "batches", number)
        if number == 2:
            table.fold(spark, least=2)
    table.fold(spark)
    return _deal_state(table, spark)


@register
def front_data_by_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Sums per account and day kept by signed changes: batches out of order of time, with late changes, one fed twice."""
    path = new_folder(spark, "sums")
    state, totals = sums.day_state_table(f"{path}/state"), sums.account_sums_table(f"{path}/sums")
    log = cdc.change_log(cdc.valid_changes(bindings.deal_wire(spark, folder), TRADES), TRADES)
    for part in (2, 0, 1, 0):
        sums.add_day_changes(log.where(F.col("scn") % 3 == part), state)
        sums.update_account_sums(spark, state, totals)
    return _typed(sums.front_data(spark, totals, dt.date(2024, 1, 15)))


MOVED_FROM = 1_705_000_000_000


@register
def dim_back_account_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Account codes touched by each of two deliveries are recomputed; in the second one all accounts change their code."""
    path = new_folder(spark, "accounts")
    feed = specs.ACCOUNT_FEED
    state, dim = cdc.state_table(f"{path}/state", feed), sums.account_dim_table(f"{path}/dim")
    changes = cdc.valid_changes(bindings.account_wire(spark, folder, MOVED_FROM), feed)
    later = F.col("ts_ms") >= MOVED_FROM
    for number, part in enumerate((changes.where(~later), changes.where(later))):
        cdc.apply_changes(part, feed, state, BUCKETS, "deliveries", number)
        sums.update_account_dim(spark, state, dim, BUCKETS)
    return sums.account_dim(spark, dim).drop("C_OPEN_DATE")


@register
def change_log_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The change log in three deliveries; closed days are folded after two of them and again after the third, which has
    more rows for these days."""
    path = new_folder(spark, "log")
    wire = bindings.account_wire(spark, folder).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(3)))
    log = CompactedLog(f"{path}/log", f"{path}/compacted")
    for part in range(3):
        wire.where(F.col("part") == part).select("value").write.mode("append").text(f"{path}/wire")
        cdc.start_change_log(
            spark, FileStream(f"{path}/wire"), specs.ACCOUNT_FEED, log.log, f"{path}/checkpoint").awaitTermination()
        if part:
            log.compact(spark, dt.date(2024, 1, 20), least=1 + part)
    return log.read(spark).select(
        "PK_ACCOUNT", "created_at", "updated_at", "op", "C_ACCOUNT_CODE", "C_CHANNEL", "partition_date", "ts_ms",
        F.col("scn").cast("bigint").alias("scn"),
    )


@register
def cdc_restart_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """The later half of the changes first, a restart for the earlier half, then everything again."""
    path = new_folder(spark, "restart")
    wire = bindings.deal_wire(spark, folder)
    later = F.get_json_object("value", "$.payload.ts_ms").cast("bigint") >= 1_705_000_000_000
    table = cdc.state_table(f"{path}/table", specs.DEAL_FEED)

    def run(checkpoint: str) -> None:
        cdc.start_apply_changes(
            spark, FileStream(f"{path}/wire"), specs.DEAL_FEED, table, f"{path}/{checkpoint}", BUCKETS
        ).awaitTermination()

    wire.where(later).write.mode("append").text(f"{path}/wire")
    run("first")
    wire.where(~later).write.mode("append").text(f"{path}/wire")
    run("first")
    run("again")
    return _deal_state(table, spark)


@register
def dim_back_account_stream(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "accounts")
    bindings.account_wire(spark, folder).write.text(f"{path}/wire")
    table = cdc.state_table(f"{path}/table", specs.ACCOUNT_FEED)
    cdc.start_apply_changes(
        spark, FileStream(f"{path}/wire"), specs.ACCOUNT_FEED, table, f"{path}/checkpoint", BUCKETS
    ).awaitTermination()
    return gold.back_account_dim(table.read(spark)).drop("C_OPEN_DATE")


@register
def tick_parse(spark: SparkSession, folder: str) -> DataFrame:
    return ticks.parse_ticks(bindings.tick_wire(spark, folder)).select(
        "MessageType", "IndexCode", "Last_updated", "IndexValue", "TotalTrades", "TotalValuesTraded"
    )


@register
def tick_flatten(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "ticks")
    bindings.tick_wire(spark, folder).write.text(f"{path}/wire")
    ticks.start_tick_table(
        spark, FileStream(f"{path}/wire"), f"{path}/table", f"{path}/checkpoint"
    ).awaitTermination()
    stored = warehouse.scan(spark, f"{path}/table")
    filled = ["MessageType", "Last_updated", "IndexCode", "IndexValue", "TotalTrades", "TotalValuesTraded", "Time"]
    empty = F.lit(0)
    for name in schemas.TICK_COLUMNS:
        if name not in filled:
            empty = empty + F.col(name).isNotNull().cast("int")
    return stored.select(*filled, empty.alias("other_values"))


@register
def market_turnover_live(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries of ticks for the same days, the open one included; the second corrects what the first gave."""
    path = new_folder(spark, "turnover")
    wire = bindings.tick_wire(spark, folder).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(2)))
    for part in range(2):
        wire.where(F.col("part") == part).select("value").write.mode("append").text(f"{path}/wire")
        ticks.start_tick_table(spark, FileStream(f"{path}/wire"), f"{path}/ticks", f"{path}/checkpoint").awaitTermination()
        refresh.start_turnover_refresh(
            spark, f"{path}/ticks", f"{path}/table", f"{path}/refresh-checkpoint").awaitTermination()
    return warehouse.scan(spark, f"{path}/table")


@register
def market_turnover_stream(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "turnover")
    bindings.tick_wire(spark, folder).write.text(f"{path}/wire")
    ticks.start_turnover(
        spark, FileStream(f"{path}/wire"), f"{path}/table", f"{path}/checkpoint", delay="10 minutes"
    ).awaitTermination()
    return warehouse.scan(spark, f"{path}/table")
