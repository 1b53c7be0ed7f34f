"""Scans of stored tables, with the partition predicate in the form that prunes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlake.functions.times import between_days, year_range


def scan(
    spark: SparkSession, path: str, schema: StructType | None = None, drifted: bool = False
) -> DataFrame:
    """Parquet table. With a schema, partition columns keep their declared types (a string month stays a string).
    ``drifted`` merges the schemas of all files, for tables that gained columns; it reads every footer."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    return spark.read.option("mergeSchema", str(drifted).lower()).parquet(path)


def scan_days(df: DataFrame, first: dt.date, end: dt.date, column: str = "partition_date") -> DataFrame:
    """Rows of ``[first, end)``. A table stored by month or year is also cut by that column, which prunes its files."""
    days = df.where(between_days(df, column, first, end))
    for stored, start in (("partition_month", first.replace(day=1)), ("partition_year", first.replace(month=1, day=1))):
        if stored in df.columns:
            days = days.where(between_days(df, stored, start, end))
    return days


def scan_day(df: DataFrame, day: dt.date, column: str = "partition_date") -> DataFrame:
    return scan_days(df, day, day + dt.timedelta(days=1), column)


def scan_year(df: DataFrame, year: int, column: str = "partition_date") -> DataFrame:
    """A date range rather than ``year(column) = y``, which would read every partition."""
    return scan_days(df, *year_range(year), column)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
