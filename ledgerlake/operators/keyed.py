"""Tables with a primary key on plain parquet: an append is an upsert.

Rows are grouped by one or more partition columns that are functions of the key (a date inside the key, a year and a month,
or a hash bucket), so all versions of a key share a partition. Every write goes to a folder of its own, ``data/write=...``.
A small commit then names, for every partition, the folder of its base and those of its deltas. Readers follow the
newest commit, so a write that dies half-way leaves the table as it was, and its retry is harmless.

There are two ways to load. ``upsert`` merges the changes into the base of the partitions they touch, which suits loads
that touch few. ``append_delta`` writes the changes alone, at their own cost, and readers keep the newest row per key of
base and deltas; ``fold`` turns deltas into a base from time to time. Merging by ``order`` makes a repeated load harmless,
and a load may carry the number of its batch, so that a repeated batch is skipped altogether.

Of two writers at a time one commits first. The other one commits after it, on top of it; where both have rewritten the same
partition it merges again, ``RETRIES`` times at most. Rows without a full key are no version of anything; they are kept
in ``rejects``.

The driver only sees partition values and batch numbers: days, months or buckets, never keys.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Collection, Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.operators import storage
from ledgerlake.operators.latest import latest_version
from ledgerlake.operators.projections import split_null_keys
from ledgerlake.operators.tables import overwrite

RETRIES = 5
COMMIT = "part string, base string, deltas array<string>, source string, batch bigint"


def bucket(keys: list[str], buckets: int) -> Column:
    """Hash bucket of a key, the partition column of tables without a date in the key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class LostRace(RuntimeError):
    """Another writer has changed the partitions that a write has merged."""


@dataclass(frozen=True)
class Part:
    """Folders that hold a partition: its base, if there is one, and its deltas, oldest first."""

    base: str | None = None
    deltas: tuple[str, ...] = ()

    @property
    def folders(self) -> tuple[str, ...]:
        return self.deltas if self.base is None else (self.base, *self.deltas)


@dataclass(frozen=True)
class Commit:
    """State of a table: its partitions, and per source of batches the number of the last batch taken."""

    version: int | None = None
    parts: dict[str, Part] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class KeyedTable:
    """``order`` decides which version of a key is newest; ``deleted`` names a boolean column marking tombstones,
    which stay stored so that an older change cannot revive a row, and which ``read`` leaves out. ``partition`` names one
    column, a date, a number or plain text, or several; a partition is then known by their values with ``/`` between. A small
    table may have none; all its rows are one partition."""

    path: str
    schema: StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]
    partition: str | tuple[str, ...]
    deleted: str | None = None

    @property
    def partition_by(self) -> tuple[str, ...]:
        return (self.partition,) if isinstance(self.partition, str) else self.partition

    # --- commits ---

    def last_version(self, spark: SparkSession) -> int | None:
        """Number of the newest commit, from the names of the commits alone."""
        names = storage.children(spark, f"{self.path}/commits")
        return max((int(name.split("=")[1]) for name in names if name.startswith("version=")), default=None)

    def commit(self, spark: SparkSession, version: int | None = None) -> Commit:
        """The given commit, the newest one unless told otherwise."""
        version = self.last_version(spark) if version is None else version
        if version is None:
            return Commit()
        rows = spark.read.schema(COMMIT).json(f"{self.path}/commits/version={version}").collect()
        return Commit(
            version,
            {row.part: Part(row.base, tuple(row.deltas or ())) for row in rows if row.part is not None},
            {row.source: row.batch for row in rows if row.source is not None},
        )

    def _publish(self, spark: SparkSession, edit: Callable[[Commit], Commit | None]) -> int | None:
        """Commit what ``edit`` makes of the newest commit, again on top of that of a faster writer; None if ``edit``
        finds nothing to do."""
        for _ in range(RETRIES):
            last = self.commit(spark)
            new = edit(last)
            if new is None:
                return last.version
            version = 0 if last.version is None else last.version + 1
            attempt = f"{self.path}/commits/_attempt-{uuid.uuid4().hex}"
            rows = [(part, at.base, list(at.deltas), None, None) for part, at in sorted(new.parts.items())]
            rows += [(None, None, None, source, batch) for source, batch in sorted(new.batches.items())]
            spark.createDataFrame(rows, COMMIT).coalesce(1).write.json(attempt)
            if storage.rename_new(spark, attempt, f"{self.path}/commits/version={version}"):
                return version
            storage.remove(spark, attempt)
        raise LostRace(f"{self.path}: {RETRIES} commits lost against other writers")

    # --- reading ---

    def _rows(self, spark: SparkSession, places: Iterable[tuple[str, str]]) -> DataFrame:
        """Rows of (partition, folder) pairs, as written."""
        paths = [f"{self.path}/data/write={folder}/{self._folder(part)}".rstrip("/") for part, folder in places]
        if not paths:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*paths)
        return rows.select(*self.schema.names)

    def _folder(self, part: str) -> str:
        values = part.split("/") if self.partition_by else []
        return "/".join(f"{name}={value}" for name, value in zip(self.partition_by, values, strict=True))

    def stored(
        self, spark: SparkSession, parts: dict[str, Part], keys: DataFrame | None = None, columns: Sequence[str] | None = None
    ) -> DataFrame:
        """Newest row per key of the given partitions, tombstones included; only of these ``keys`` and with these ``columns``
        besides key and order, if any are given."""
        names = self.schema.names
        if columns is not None:
            needed = {*columns, *self.keys, *self.order, *((self.deleted,) if self.deleted else ())}
            names = [name for name in names if name in needed]
        single = {part: at for part, at in parts.items() if len(at.folders) == 1}
        several = {part: at for part, at in parts.items() if len(at.folders) > 1}

        def rows(chosen: dict[str, Part]) -> DataFrame:
            found = self._rows(spark, ((part, folder) for part, at in chosen.items() for folder in at.folders))
            return found.select(*names) if keys is None else found.join(keys, list(self.keys), "left_semi").select(*names)

        if not several:
            return rows(single)
        merged = latest_version(rows(several), self.keys, self.order)
        return rows(single).unionByName(merged) if single else merged

    def read(
        self, spark: SparkSession, parts: Collection[str] | None = None, version: int | None = None,
        columns: Sequence[str] | None = None,
    ) -> DataFrame:
        """Current rows, of the given partitions only if there are any given; with several partition columns the first
        values alone name all partitions below them. An older version can be read while its commit is kept. ``columns`` are those
        that are read besides key and order."""
        rows = self.stored(spark, self._chosen(self.commit(spark, version).parts, parts), columns=columns)
        return rows.where(~F.col(self.deleted)) if self.deleted else rows

    @staticmethod
    def _chosen(known: dict[str, Part], parts: Collection[str] | None) -> dict[str, Part]:
        if parts is None:
            return known
        wanted = set(parts)
        return {part: at for part, at in known.items()
                if any("/".join(part.split("/")[:size]) in wanted for size in range(1, part.count("/") + 2))}

    def changes_between(self, spark: SparkSession, old: int | None, new: int) -> DataFrame:
        """Keys whose row differs between two versions, with the structs ``before`` and ``after`` of their other columns,
        NULL where there is no row. ``old`` may be None for a table that had no commit yet.

        Only partitions that differ are read, and where these only gained deltas, only the keys of the new deltas."""
        was = Commit() if old is None else self.commit(spark, old)
        now = self.commit(spark, new)
        grown, other = {}, [] if was.parts else sorted(now.parts)
        for part in sorted({*was.parts, *now.parts}) if was.parts else ():
            a, b = was.parts.get(part, Part()), now.parts.get(part, Part())
            if a != b:
                if a.base == b.base and b.deltas[:len(a.deltas)] == a.deltas:
                    grown[part] = b.deltas[len(a.deltas):]
                else:
                    other.append(part)
        sides = []
        for commit in (was, now):
            rows = [self.stored(spark, {part: commit.parts[part] for part in other if part in commit.parts})]
            if grown:
                places = ((part, folder) for part, folders in grown.items() for folder in folders)
                keys = self._rows(spark, places).select(*self.keys).distinct()
                rows.append(self.stored(spark, {part: commit.parts[part] for part in grown if part in commit.parts}, keys))
            sides.append(reduce(DataFrame.unionByName, rows))
        rest = [name for name in self.schema.names if name not in self.keys]

        def side(rows: DataFrame, name: str) -> DataFrame:
            row = F.struct(*rest)
            return rows.select(*self.keys, (F.when(~F.col(self.deleted), row) if self.deleted else row).alias(name))

        if not was.parts:  # a first load: all rows are new
            first = side(sides[1], "after")
            return first.where("after IS NOT NULL").select(*self.keys, F.lit(None).cast(first.schema["after"].dataType).alias("before"), "after")
        both = side(sides[0], "before").join(side(sides[1], "after"), list(self.keys), "full_outer")
        return both.where(~F.col("before").eqNullSafe(F.col("after")))

    # --- writing ---

    def upsert(self, changes: DataFrame, touched: list[str] | None = None, gathered: bool = False) -> int:
        """Merge ``changes`` into the partitions they touch and return the version that holds them.

        ``touched`` lists the partitions of the changes where the caller knows them, as a daily load does. A load that holds
        others fails before it is committed. Otherwise the changes are first written aside by partition, which tells the
        partitions and reads the source of the changes once. The first load of a table has nothing to merge with and needs
        neither; if it is ``gathered``, as for ``tables.overwrite``, its rows are written by the tasks that read them.
        """
        spark = changes.sparkSession
        seen = self.commit(spark)
        if seen.parts:
            rows = self._keyed(changes)
        else:
            rows, folder, parts = self._first_load(changes, gathered)
            try:
                return self._rewritten(spark, seen, dict.fromkeys(parts, Part(folder)))
            except LostRace:
                pass  # to be merged with a faster first load
        aside, known = None, touched
        try:
            for _ in range(RETRIES):
                seen = self.commit(spark)
                if seen.parts and known is None:
                    aside = f"{self.path}/aside/{uuid.uuid4().hex}"
                    overwrite(rows, aside, self.partition_by)
                    known = self._parts(spark, aside)
                    rows = spark.read.schema(self.schema).parquet(aside).select(*self.schema.names)
                old = {part: seen.parts[part] for part in known or () if part in seen.parts}
                merged = self.stored(spark, old).unionByName(rows) if old else rows
                folder, parts = self._write(latest_version(merged, self.keys, self.order))
                if seen.parts and touched is not None and (missing := sorted(set(parts) - set(touched))):
                    raise ValueError(f"the changes touch partitions that were not announced: {', '.join(missing)}")
                try:
                    return self._rewritten(spark, seen, dict.fromkeys(parts, Part(folder)))
                except LostRace:
                    continue
        finally:
            if aside:
                storage.remove(spark, aside)
        raise LostRace(f"{self.path}: merged {RETRIES} times, and another writer was faster each time")

    def append_delta(self, changes: DataFrame, source: str | None = None, batch: int | None = None, onto: Commit | None = None) -> int | None:
        """Add the newest change per key as a delta and return the version that holds it. A batch of ``source`` whose number is
        not above that of the last one taken is skipped. Changes that were computed from the rows of a commit name it as
        ``onto``; they are refused once there is a newer one."""
        spark = changes.sparkSession

        def is_known(last: Commit) -> bool:
            return source is not None and last.batches.get(source, -1) >= batch

        if is_known(last := self.commit(spark)):
            return last.version
        folder, parts = self._write(latest_version(self._keyed(changes), self.keys, self.order))

        def edit(last: Commit) -> Commit | None:
            if is_known(last) or (not parts and source is None):
                return None
            if onto is not None and last.version != onto.version:
                raise LostRace(self.path)
            grown = {part: replace(last.parts.get(part, Part()), deltas=(*last.parts.get(part, Part()).deltas, folder)) for part in parts}
            batches = last.batches if source is None else {**last.batches, source: batch}
            return Commit(None, {**last.parts, **grown}, batches)

        return self._publish(spark, edit)

    def fold(self, spark: SparkSession, least: int = 1) -> int | None:
        """Turn base and deltas of the partitions with at least that many deltas into a new base."""
        for _ in range(RETRIES):
            seen = self.commit(spark)
            due = {part: at for part, at in seen.parts.items() if len(at.deltas) >= least}
            if not due:
                return seen.version
            folder, _ = self._write(self.stored(spark, due))
            try:
                return self._rewritten(spark, seen, dict.fromkeys(due, Part(folder)))
            except LostRace:
                continue
        raise LostRace(f"{self.path}: folded {RETRIES} times, and another writer was faster each time")

    def replace(self, rows: DataFrame, parts: Collection[str], source: str | None = None, batch: int | None = None) -> int | None:
        """Put ``rows`` in the place of the given partitions; one that has no rows left is gone. Partitions that have no rows
        before and after may be named too."""
        spark = rows.sparkSession
        seen = self.commit(spark)
        folder, written = self._write(self._keyed(rows))
        if missing := sorted(set(written) - set(parts)):
            raise ValueError(f"rows for partitions that are not replaced: {', '.join(missing)}")
        new = dict.fromkeys(parts, None) | dict.fromkeys(written, Part(folder))
        return self._rewritten(spark, seen, new, {} if source is None else {source: batch})

    def expire(self, spark: SparkSession, keep: int = 20, older_than: dt.timedelta = dt.timedelta(days=1)) -> None:
        """Remove all commits but the newest ``keep`` and the folders that none of these names. Folders that have changed
        within ``older_than`` stay, since a write may be about to commit them."""
        versions = sorted(int(name.split("=")[1]) for name in storage.children(spark, f"{self.path}/commits")
                          if name.startswith("version="))
        for version in versions[:-keep]:
            storage.remove(spark, f"{self.path}/commits/version={version}")
        named = {f"write={folder}" for version in versions[-keep:] for at in self.commit(spark, version).parts.values()
                 for folder in at.folders}
        before = dt.datetime.now(dt.timezone.utc) - older_than
        for name, changed in storage.children(spark, f"{self.path}/data").items():
            if name not in named and changed <= before:
                storage.remove(spark, f"{self.path}/data/{name}")

    def _keyed(self, changes: DataFrame) -> DataFrame:
        """The changes that have a key; the others go to ``rejects``."""
        rows, rejected = split_null_keys(changes.select(*self.schema.names), list(self.keys))
        rejected.write.mode("append").parquet(f"{self.path}/rejects")
        return rows

    def _first_load(self, changes: DataFrame, gathered: bool) -> tuple[DataFrame, str, list[str]]:
        """The changes that have a key, and the folder and partitions of the newest row of each.

        Keys seldom repeat within a first load. So rows are written as they come, in one evaluation that also counts those
        without key, and of what is written only 64-bit hashes of the keys move. Only rows whose hash repeats are then
        compared, and all are written once more without moving the others.
        """
        spark, keys = changes.sparkSession, list(self.keys)
        no_key = reduce(Column.__or__, (F.col(key).isNull() for key in keys))
        seen, names = Observation(), self.schema.names
        rows, _ = split_null_keys(changes.select(*names).observe(seen, F.count_if(no_key).alias("rejected")), keys)
        folder, parts = self._write(rows, gathered)
        written = self._rows(spark, ((part, folder) for part in parts)).withColumn("_hash", F.xxhash64(*keys))
        rows, rejected = split_null_keys(changes.select(*names), keys)
        if not written.isEmpty() and not seen.get["rejected"]:  # without rows, the count may have been optimized away
            rejected = spark.createDataFrame([], rejected.schema)
        rejected.write.mode("append").parquet(f"{self.path}/rejects")
        aside = f"{self.path}/aside/{uuid.uuid4().hex}"
        try:
            written.groupBy("_hash").agg(F.count("*").alias("_rows")).where("_rows > 1").select("_hash").write.parquet(aside)
            repeated = spark.read.schema("_hash long").parquet(aside)
            if not repeated.isEmpty():
                newest = latest_version(written.join(repeated, "_hash", "left_semi").select(*names), self.keys, self.order)
                once = written.join(repeated, "_hash", "left_anti").select(*names)
                doubled = folder
                folder, parts = self._write(once.unionByName(newest), gathered)
                storage.remove(spark, f"{self.path}/data/write={doubled}")
        finally:
            storage.remove(spark, aside)
        return rows, folder, parts

    def _write(self, rows: DataFrame, gathered: bool = False) -> tuple[str, list[str]]:
        """Write to a folder of its own; its name and the partitions in it."""
        folder = uuid.uuid4().hex
        path = f"{self.path}/data/write={folder}"
        overwrite(rows, path, self.partition_by, gathered)
        return folder, self._parts(rows.sparkSession, path)

    def _parts(self, spark: SparkSession, path: str) -> list[str]:
        """Partitions that a folder holds."""
        if not self.partition_by:
            return [""] if any(name.endswith(".parquet") for name in storage.children(spark, path)) else []
        found = storage.partition_folders(spark, path, len(self.partition_by))
        return ["/".join(name.split("=", 1)[1] for name in at.split("/")) for at in found]

    def _rewritten(self, spark: SparkSession, seen: Commit, new: dict[str, Part | None], batches: dict[str, int] | None = None) -> int | None:
        """Commit new bases made from what ``seen`` holds."""

        def edit(last: Commit) -> Commit | None:
            if any(last.parts.get(part) != seen.parts.get(part) for part in new):
                raise LostRace(self.path)
            parts = {part: at for part, at in {**last.parts, **new}.items() if at is not None}
            return Commit(None, parts, {**last.batches, **(batches or {})}) if parts or last.version is not None or batches else None

        return self._publish(spark, edit)
