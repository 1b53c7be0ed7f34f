"""Folding the small files of an append-only log that a stream writes.

A stream leaves a file per task and batch. ``compact`` rewrites the closed days into few files beside the log, and a commit
names, per day, the new folder and the files of the log that it replaces. Readers of the log through ``read`` take the new
files instead of those, and whatever has been appended since; the commit is one rename, so they see all of a day or
nothing of it. The log itself is not touched: streaming readers and the writer go on with it.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators import storage
from ledgerlake.operators.keyed import LostRace
from ledgerlake.operators.tables import overwrite

COMMIT = "day string, folder string, files array<string>"


@dataclass(frozen=True)
class CompactedLog:
    """``log`` is the folder that the stream writes, partitioned by ``day``; ``path`` takes the compacted days."""

    log: str
    path: str
    day: str = "partition_date"

    def _version(self, spark: SparkSession) -> int | None:
        names = [name for name in storage.children(spark, f"{self.path}/commits") if name.startswith("version=")]
        return max((int(name.split("=")[1]) for name in names), default=None)

    def days(self, spark: SparkSession) -> dict[str, tuple[str, frozenset[str]]]:
        """Per compacted day its folder and the names of the files of the log it replaces."""
        version = self._version(spark)
        if version is None:
            return {}
        rows = spark.read.schema(COMMIT).json(f"{self.path}/commits/version={version}").collect()
        return {row.day: (row.folder, frozenset(row.files)) for row in rows}

    def _open_files(self, spark: SparkSession, days: dict[str, tuple[str, frozenset[str]]]) -> dict[str, list[str]]:
        """Files of the log that no compacted day replaces, by day. The stream's own list of its files is what counts."""
        found: dict[str, list[str]] = {}
        for file in spark.read.parquet(self.log).inputFiles():
            day = re.search(f"/{self.day}=([^/]+)/", file)[1]
            if file.rsplit("/", 1)[1] not in days.get(day, ("", frozenset()))[1]:
                found.setdefault(day, []).append(file)
        return found

    def _rows(self, spark: SparkSession, schema, folders: dict[str, str], files: list[str]) -> DataFrame:
        """Rows of compacted days and of files of the log."""
        parts = []
        if folders:
            places = [f"{self.path}/data/write={folder}/{self.day}={day}" for day, folder in sorted(folders.items())]
            parts.append(spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*places).select(*schema.names))
        if files:
            parts.append(spark.read.schema(schema).option("basePath", self.log).parquet(*files).select(*schema.names))
        if not parts:
            return spark.createDataFrame([], schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows of the log."""
        days = self.days(spark)
        schema = spark.read.parquet(self.log).schema
        files = [file for names in self._open_files(spark, days).values() for file in names]
        return self._rows(spark, schema, {day: folder for day, (folder, _) in days.items()}, files)

    def compact(self, spark: SparkSession, before: dt.date, least: int = 2) -> list[str]:
        """Rewrite the days before ``before`` that have at least ``least`` files outside their compacted folder, and return
        them. Rows that arrived for a compacted day are folded in by the next run."""
        version, days = self._version(spark), self.days(spark)
        waiting = {
            day: files for day, files in self._open_files(spark, days).items() if day < before.isoformat() and len(files) >= least
        }
        if not waiting:
            return []
        schema = spark.read.parquet(self.log).schema
        own = {day: days[day][0] for day in waiting if day in days}
        folder = uuid.uuid4().hex
        rows = self._rows(spark, schema, own, [file for files in waiting.values() for file in files])
        overwrite(rows, f"{self.path}/data/write={folder}", [self.day])
        for day, files in waiting.items():
            replaced = days.get(day, ("", frozenset()))[1]
            days[day] = (folder, replaced | {file.rsplit("/", 1)[1] for file in files})
        attempt = f"{self.path}/commits/_attempt-{uuid.uuid4().hex}"
        commit = [(day, at, sorted(files)) for day, (at, files) in sorted(days.items())]
        spark.createDataFrame(commit, COMMIT).coalesce(1).write.json(attempt)
        if not storage.rename_new(spark, attempt, f"{self.path}/commits/version={0 if version is None else version + 1}"):
            raise LostRace(f"{self.path}: another run has compacted meanwhile")
        return sorted(waiting)
