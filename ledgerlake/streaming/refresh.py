"""Refresh of derived tables: recompute what a load touched and replace it.

What a load touched is read from the difference of two versions of a keyed table, with the rows as they were before and as
they are now, so a corrected row is taken out of the period, account or month that it has left. ``Product`` declares which
tables a derived table depends on; ``refresh_product`` follows that, and keeps per product the versions it has seen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions.times import MARKET_ZONE, period_start
from ledgerlake.operators import tables
from ledgerlake.operators.keyed import KeyedTable
from ledgerlake.plans import gold
from ledgerlake.sources.warehouse import scan_days


def touched_periods(rows: DataFrame, date_column: str, grain: str = "day") -> list[dt.date]:
    """First days of the periods that occur in ``rows``: at most one value per calendar day."""
    periods = rows.select(period_start(date_column, grain).alias("period")).distinct().where("period IS NOT NULL")
    return sorted(row.period for row in periods.collect())


def both_sides(changes: DataFrame) -> DataFrame:
    """The rows of a difference of versions, those before and those after, without their keys."""
    before, after = changes.select("before").where("before IS NOT NULL"), changes.select("after").where("after IS NOT NULL")
    return before.select("before.*").unionByName(after.select("after.*"))


def _period_end(period: dt.date, grain: str) -> dt.date:
    if grain == "day":
        return period + dt.timedelta(days=1)
    months = 1 if grain == "month" else 12
    year, month = divmod(period.year * 12 + period.month - 1 + months, 12)
    return dt.date(year, month + 1, 1)


def rows_of_periods(df: DataFrame, date_column: str, periods: list[dt.date], grain: str = "day") -> DataFrame:
    """Rows of the given periods, read from their partitions alone where the table is stored by that day. The enclosing range
    is a predicate of its own, because it reaches the scan of other tables."""
    if not periods:
        return df.limit(0)
    chosen = gold.rows_of_days(df, date_column, periods[0], _period_end(periods[-1], grain))
    # As text, since a list of thousands of days takes long to hand over value by value.
    days = ", ".join(f"DATE '{period}'" for period in periods)
    if grain == "day" and "partition_date" in df.columns and date_column in gold.PARTITION_DATES:
        return chosen.where(f"partition_date IN ({days})")
    return chosen.withColumn("_period", period_start(date_column, grain)).where(f"_period IN ({days})").drop("_period")


def refresh_account_days(
    margin: DataFrame, debit: DataFrame, advances: DataFrame, deals: DataFrame,
    path: str, periods: list[dt.date], grain: str = "day",
) -> None:
    """Recompute the given periods of the stored ``back_data`` from the whole fact tables and replace them; periods that come
    out empty are removed.

    Late advances are one reason: they are extracted by approval time but belong to the day of withdrawal. Corrected rows that
    have moved to another day are the other: the periods have to include the day they have left (``both_sides``).
    """
    fresh = gold.back_data(
        rows_of_periods(margin, "C_TRADING_DATE", periods, grain),
        rows_of_periods(debit, "C_TRANSACTION_DATE", periods, grain),
        rows_of_periods(advances, "C_WITHDRAW_DATE", periods, grain),
        rows_of_periods(deals, "C_TRANSACTION_DATE", periods, grain),
    )
    gold.write_account_days(fresh, path, grain, periods)


def refresh_ranking_months(detail: DataFrame, path: str, months: list[tuple[int, int]]) -> None:
    """Recompute the rankings that the detail of the given (year, month) pairs gives; each takes effect in one month."""
    chosen = F.struct(F.col("C_YEAR").cast("int").alias("y"), F.col("C_MONTH").cast("int").alias("m")).isin(
        [F.struct(F.lit(year).alias("y"), F.lit(month).alias("m")) for year, month in months])
    tables.overwrite_partitions(gold.erc_ranking(detail.where(chosen)), path, ["C_YEAR_ADJ", "C_MONTH_ADJ"])


def touched_months(changes: DataFrame) -> list[tuple[int, int]]:
    """(year, month) pairs of ranking detail that occur before or after."""
    pairs = both_sides(changes).select(F.col("C_YEAR").cast("int").alias("y"), F.col("C_MONTH").cast("int").alias("m"))
    return sorted((row.y, row.m) for row in pairs.where("y IS NOT NULL AND m IS NOT NULL").distinct().collect())


# --- products and the tables they depend on ---


@dataclass(frozen=True)
class Product:
    """A derived table. ``refresh`` gets the changes of each source that has some; it has to give the same table when it
    is repeated, because the versions seen are stored after it."""

    name: str
    sources: dict[str, KeyedTable]
    refresh: Callable[[SparkSession, dict[str, DataFrame]], None]


def seen_versions(spark: SparkSession, path: str) -> dict[str, int]:
    """Versions of its sources that a product holds; none for one that was never built."""
    try:
        return {row.source: row.version for row in spark.read.schema("source string, version bigint").json(path).collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def refresh_product(spark: SparkSession, product: Product, path: str) -> dict[str, int]:
    """Bring a product up to date with its sources and return the versions it now holds. ``path`` keeps them; without
    it, or before the first run, all rows of the sources are changes."""
    seen = seen_versions(spark, path)
    now = {name: version for name, table in product.sources.items() if (version := table.last_version(spark)) is not None}
    changes = {
        name: product.sources[name].changes_between(spark, seen.get(name), version)
        for name, version in now.items() if seen.get(name) != version
    }
    if changes:
        product.refresh(spark, changes)
        spark.createDataFrame(sorted(now.items()), "source string, version bigint").coalesce(1).write.mode("overwrite").json(path)
    return now


BUSINESS_DATES = {"margin": "C_TRADING_DATE", "debit": "C_TRANSACTION_DATE", "advances": "C_WITHDRAW_DATE", "deals": "C_TRANSACTION_DATE"}


def account_days_product(
    facts: dict[str, KeyedTable], path: str, grain: str = "day",
    read: Callable[[SparkSession, list[dt.date]], tuple[DataFrame, ...]] | None = None,
) -> Product:
    """``back_data`` of the four facts (keys as in ``BUSINESS_DATES``): the days that changed rows had or have. ``read`` gives
    the facts of some days, where fewer partitions than all can be read for them."""

    def refresh(spark: SparkSession, changes: dict[str, DataFrame]) -> None:
        days = sorted({day for name, rows in changes.items() for day in touched_periods(both_sides(rows), BUSINESS_DATES[name], grain)})
        if days:
            whole = read(spark, days) if read else [facts[name].read(spark) for name in BUSINESS_DATES]
            refresh_account_days(*whole, path, days, grain)

    return Product("back_data", facts, refresh)


def ranking_product(detail: KeyedTable, path: str) -> Product:
    """``dim_erc_ranking``: the months of the changed detail rows, read from their partitions."""

    def refresh(spark: SparkSession, changes: dict[str, DataFrame]) -> None:
        if months := touched_months(changes["detail"]):
            parts = {f"{year}/{month}" for year, month in months}
            refresh_ranking_months(detail.read(spark, parts), path, months)

    return Product("dim_erc_ranking", {"detail": detail}, refresh)


# --- turnover of ticks ---


def refresh_turnover(ticks: DataFrame, path: str, first: dt.date, end: dt.date, zone: str = MARKET_ZONE) -> None:
    """Recompute the local days in ``[first, end)`` of the stored turnover from the tick table."""
    days = scan_days(ticks, first, end)
    tables.overwrite_partitions(gold.market_turnover(days, zone), path, ["C_DATE"])


def start_turnover_refresh(
    spark: SparkSession, ticks: str, path: str, checkpoint: str, zone: str = MARKET_ZONE
) -> StreamingQuery:
    """Bring the stored turnover up to date with everything new in the tick table, then stop.

    The local days of new ticks are recomputed from the whole tick table and replaced, so the running day shows and a
    late tick corrects its day, however late. A batch that is repeated recomputes the same days.
    """

    def recompute(batch: DataFrame, _batch_id: int) -> None:
        days = touched_periods(batch, "partition_date")
        stored = batch.sparkSession.read.parquet(ticks).where(F.col("partition_date").isin(days))
        tables.overwrite_partitions(gold.market_turnover(stored, zone), path, ["C_DATE"])

    return (
        spark.readStream.schema(spark.read.parquet(ticks).schema).parquet(ticks).writeStream.foreachBatch(recompute)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
