"""Index from a business day to the stored partitions that hold rows of it, for tables stored by another date.

Advances are stored by the day of approval but wanted by the day of withdrawal. Each load notes the distinct pairs of both
days before it commits its rows, so the index always names every partition that has rows of a day. Pairs of rows that
have been corrected since stay; they cost a partition read in vain, until ``rebuild``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.times import between_days
from ledgerlake.operators import storage, tables


@dataclass(frozen=True)
class DayIndex:
    """``business`` is the date that is asked for, ``stored`` the partition column. Pairs are stored by business year."""

    path: str
    business: str
    stored: str = "partition_date"

    def pairs(self, rows: DataFrame) -> DataFrame:
        day = F.to_date(self.business)
        return rows.select(day.alias("day"), F.col(self.stored).cast("string").alias("part"), F.year(day).alias("year")).where(
            "day IS NOT NULL AND part IS NOT NULL").distinct()

    def add(self, rows: DataFrame) -> None:
        """Note the pairs of a load; to be called before the load is committed."""
        tables.append(self.pairs(rows), self.path, ["year"])

    def rebuild(self, rows: DataFrame) -> None:
        """The pairs of all stored ``rows`` in the place of the present ones."""
        tables.overwrite(self.pairs(rows), self.path, ["year"])

    def parts(self, spark: SparkSession, first: dt.date, end: dt.date) -> set[str] | None:
        """Partitions that may hold rows of the business days in ``[first, end)``; None without an index. The driver gets at
        most a value per stored partition."""
        if not storage.children(spark, self.path):
            return None
        known = spark.read.schema("day date, part string, year int").parquet(self.path)
        chosen = known.where(between_days(known, "day", first, end)).where(F.col("year").between(first.year, end.year))
        return {row.part for row in chosen.select("part").distinct().collect()}
