"""Writing and registering tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import storage


def gather(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together before a partitioned write, so that each partition gets few files.

    A rebalance: AQE joins small partitions and splits a large one, such as a day that holds a third of the rows.
    """
    return df.hint("rebalance", *(F.col(name) for name in partition_by)) if partition_by else df


def _overwrite(df: DataFrame, path: str, partition_by: Sequence[str], mode: str, gathered: bool) -> None:
    rows = df if gathered else gather(df, partition_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", "zstd").partitionBy(
        *partition_by
    ).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), gathered: bool = False) -> None:
    """Replace the whole table. ``gathered`` rows are not moved: those of a partition are together already, or partitions are
    so few that each task may give each of them a file."""
    _overwrite(df, path, partition_by, "static", gathered)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], gathered: bool = False) -> None:
    """Replace only the partitions that ``df`` holds; a re-run gives the same table. ``df`` may read the table."""
    _overwrite(df, path, partition_by, "dynamic", gathered)


def replace_partitions(df: DataFrame, path: str, partition: str, values: Iterable[str], gathered: bool = False) -> None:
    """Put ``df`` in the place of the partitions with these values of one column. A partition that ``df`` has no rows for is
    removed, which ``overwrite_partitions`` alone would leave as it was. A run that breaks off can be repeated."""
    spark = df.sparkSession
    known = storage.children(spark, path)
    folders = [f"{path}/{name}" for value in values if (name := f"{partition}={value}") in known]
    before = {folder: set(storage.children(spark, folder)) for folder in folders}
    overwrite_partitions(df, path, [partition], gathered)
    for folder, files in before.items():
        if files and set(storage.children(spark, folder)) == files:  # files that were written anew have new names
            storage.remove(spark, folder)


def update_where(
    spark: SparkSession, path: str, partition_by: Sequence[str], condition: Column, values: dict[str, Column]
) -> list[tuple]:
    """Set columns of the rows for which ``condition`` is true and return the partitions that were rewritten.

    Only partitions that have such rows are rewritten; the files of all others stay as they are. The condition is
    pushed down to the scan that finds them. Partition columns themselves cannot be set.
    """
    if moved := set(values) & set(partition_by):
        raise ValueError(f"partition columns cannot be updated: {', '.join(sorted(moved))}")
    stored = spark.read.parquet(path)
    found = [tuple(row) for row in stored.where(condition).select(*partition_by).distinct().collect()]  # partition values only
    if not found:
        return []
    affected = F.lit(False)
    for one in found:
        same = F.lit(True)
        for name, value in zip(partition_by, one, strict=True):
            same = same & F.col(name).eqNullSafe(F.lit(value).cast(stored.schema[name].dataType))
        affected = affected | same
    hit = F.coalesce(condition, F.lit(False))
    rows = stored.where(affected).select(*(
        F.when(hit, values[name].cast(field.dataType)).otherwise(F.col(name)).alias(name) if name in values else F.col(name)
        for name, field in ((field.name, field) for field in stored.schema.fields)
    ))
    overwrite_partitions(rows, path, partition_by)
    return sorted(found, key=str)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    gather(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def append_managed(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Append to a catalog table, created on first use."""
    gather(df, partition_by).write.mode("append").format("parquet").partitionBy(*partition_by).saveAsTable(table)


def register_external(spark: SparkSession, table: str, path: str, location: str | None = None) -> DataFrame:
    """Point a catalog table at stored parquet, replacing an earlier registration; ``location`` is for the database
    and is used when it has to be created."""
    database = table.split(".")[0]
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source="parquet")
    refresh_partitions(spark, table)
    return spark.table(table)


def refresh_partitions(spark: SparkSession, table: str) -> None:
    """Make the catalog know all stored partitions of a table; to be repeated after loads that add some."""
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)


def truncate(spark: SparkSession, path: str) -> None:
    """Empty an unpartitioned table, keeping its schema."""
    schema = spark.read.parquet(path).schema
    overwrite(spark.createDataFrame([], schema), path)
