"""Extracts from relational sources, and the same extracts over parquet copies.

A source has one method, ``table(name)``, giving a lazy frame; windows are ordinary predicates, which Spark pushes to
the database or to the parquet scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.times import between_days, previous_month, year_range


class Source(Protocol):
    def table(self, spark: SparkSession, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class ParquetSource:
    """One parquet folder or file per table."""

    root: str
    suffix: str = ""

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{name}{self.suffix}")


@dataclass(frozen=True)
class JdbcSource:
    """JDBC reads over several connections.

    ``split`` names, per table, the predicates of its read tasks. ``hash_split`` builds predicates on a hash of the
    key, which stay even when one business date holds most rows. A table without an entry is read by one connection.
    ``options`` carries url, user, password and driver from the caller.
    """

    options: dict[str, str]
    split: dict[str, list[str]] = field(default_factory=dict)
    fetch_size: int = 10_000

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        properties = {
            **{key: value for key, value in self.options.items() if key != "url"},
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
        }
        predicates = self.split.get(name)
        if predicates:
            return spark.read.jdbc(self.options["url"], name, predicates=predicates, properties=properties)
        return spark.read.jdbc(self.options["url"], name, properties=properties)


def hash_split(key: str, tasks: int, function: str = "ORA_HASH") -> list[str]:
    """Predicates that spread a table over ``tasks`` reads; NULL keys go to the first."""
    return [f"COALESCE(MOD({function}({key}), {tasks}), 0) = {task}" for task in range(tasks)]


def extract_full(spark: SparkSession, source: Source, name: str) -> DataFrame:
    return source.table(spark, name)


def extract_columns(spark: SparkSession, source: Source, name: str, columns: list[str]) -> DataFrame:
    return source.table(spark, name).select(*columns)


def extract_days(df: DataFrame, date_column: str, first: dt.date, end: dt.date) -> DataFrame:
    return df.where(between_days(df, date_column, first, end))


def extract_year(df: DataFrame, date_column: str, year: int) -> DataFrame:
    return extract_days(df, date_column, *year_range(year))


def extract_day_before(df: DataFrame, date_column: str, as_of: dt.date) -> DataFrame:
    """Rows of the day before ``as_of``."""
    return extract_days(df, date_column, as_of - dt.timedelta(days=1), as_of)


def extract_previous_month(df: DataFrame, as_of: dt.date, year: str = "C_YEAR", month: str = "C_MONTH") -> DataFrame:
    """Rows whose year and month columns name the month before ``as_of``."""
    previous_year, previous = previous_month(as_of)
    return df.where((F.col(year) == previous_year) & (F.col(month) == previous))
