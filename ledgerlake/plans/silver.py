"""Source or bronze to silver, incremental loads into keyed warehouse tables, and publishing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.functions.times import period_start, previous_month
from ledgerlake.operators import reports, tables
from ledgerlake.operators.dayindex import DayIndex
from ledgerlake.operators.keyed import KeyedTable
from ledgerlake.operators.projections import cast_columns, lineage_columns, partition_columns, publish
from ledgerlake.sources.relational import Source, extract_day_before, extract_days, extract_previous_month
from ledgerlake.specs import TableSpec


def to_silver(df: DataFrame, spec: TableSpec, loaded_at: dt.datetime, created: bool = False) -> DataFrame:
    """Partition and lineage columns plus the table's casts; ``created`` adds the first-load time ``create_at``."""
    added = {**partition_columns(spec), **lineage_columns(loaded_at)}
    if created:
        added["create_at"] = added["valid_from"]
    return cast_columns(df, spec.casts).withColumns(added)


def bronze_to_silver(
    bronze: DataFrame, spec: TableSpec, path: str, loaded_at: dt.datetime, grain: str | None = None
) -> None:
    """Rewrite the silver table of ``spec`` from its bronze copy.

    The table is partitioned as the spec says. ``grain`` (``month`` or ``year``) partitions by the first day of that
    period instead, for tables whose days are too small for a folder each; ``partition_date`` is then a column.
    """
    silver = to_silver(bronze, spec, loaded_at, created=True)
    if grain and spec.date_column:
        silver = silver.withColumn(f"partition_{grain}", period_start("partition_date", grain))
        # Years are few, so every task writes its own files of them.
        tables.overwrite(silver, path, [f"partition_{grain}"], gathered=grain == "year")
    else:
        tables.overwrite(silver, path, spec.partition_by)


def source_to_silver(
    spark: SparkSession,
    source: Source,
    spec: TableSpec,
    path: str,
    loaded_at: dt.datetime,
    first: dt.date | None = None,
    end: dt.date | None = None,
) -> int:
    """Full load, or a backfill of ``[first, end)`` in one job that replaces only the partitions it holds; the number of
    rows written."""
    rows, write = source.table(spark, spec.source), tables.overwrite
    if first is not None and end is not None:
        rows, write = extract_days(rows, spec.date_column, first, end), tables.overwrite_partitions
    return reports.write_counted(to_silver(rows, spec, loaded_at), lambda df: write(df, path, spec.partition_by))


def warehouse_table(spec: TableSpec, path: str) -> KeyedTable:
    """Keyed table of a fact or a dimension; the later load wins. Ranking detail is stored by year and month, a dimension, whose key
    does not hold its partition, as a whole."""
    return KeyedTable(path, spec.schema, spec.primary_key, ("valid_from",), spec.partition_by if spec.partition_in_key else ())


def incremental_load(
    spark: SparkSession,
    source: Source,
    spec: TableSpec,
    table: KeyedTable,
    as_of: dt.date,
    loaded_at: dt.datetime,
    index: DayIndex | None = None,
) -> int:
    """Load the day before ``as_of`` (the month before it for month tables) into the keyed table. ``index`` is told the days
    of the load first."""
    rows = source.table(spark, spec.source)
    if spec.partition_texts:
        window = extract_previous_month(rows, as_of)
        touched = dict(zip(spec.partition_texts, map(str, previous_month(as_of)), strict=True))
    else:
        window = extract_day_before(rows, spec.date_column, as_of)
        touched = {"partition_date": (as_of - dt.timedelta(days=1)).isoformat()}
    silver = publish(to_silver(window, spec, loaded_at), table.schema)
    if index:
        index.add(silver)
    return table.upsert(silver, ["/".join(touched[name] for name in table.partition_by)])


def publish_table(silver: DataFrame, spec: TableSpec) -> DataFrame:
    """Silver rows in the declared columns, order and types of the warehouse table."""
    return publish(silver, spec.schema)
