"""Row counts of a load, taken while it is written."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write`` and return the number of rows written, without a second evaluation."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def load_report(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(sorted(counts.items()), "table_name string, row_count bigint")


def record_load(spark: SparkSession, path: str, table: str, rows: int, loaded_at: dt.datetime) -> None:
    """Add the row count of a load to the list of loads."""
    counted = spark.createDataFrame([(table, rows, loaded_at)], "table_name string, row_count bigint, loaded_at timestamp_ntz")
    counted.coalesce(1).write.mode("append").parquet(path)
