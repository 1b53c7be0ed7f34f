"""Keyed tables: upsert, tombstones, interrupted loads and repeated loads."""

import datetime as dt
import os

import pytest
from ledgerlake import schemas
from ledgerlake.operators import storage
from ledgerlake.operators.keyed import KeyedTable, LostRace, bucket
from pyspark.sql import functions as F

COLUMNS = "k string, day date, v int, at int, gone boolean"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(str(tmp_path / "t"), schemas.struct(COLUMNS), ("k", "day"), ("at",), "day", deleted="gone")


def rows(spark, *values):
    return spark.createDataFrame([(k, d and dt.date(2024, 1, d), v, at, gone) for k, d, v, at, gone in values], COLUMNS)


def state(spark, table):
    return {(r.k, r.day and r.day.day): r.v for r in table.read(spark).collect()}


def test_newest_version_wins_whatever_the_order(spark, table):
    table.upsert(rows(spark, ("a", 1, 1, 10, False), ("b", 1, 2, 10, False), ("c", 2, 3, 10, False)))
    table.upsert(rows(spark, ("a", 1, 9, 5, False), ("b", 1, 8, 11, False)))
    assert state(spark, table) == {("a", 1): 1, ("b", 1): 8, ("c", 2): 3}


def test_delete_hides_the_key_also_from_older_changes(spark, table):
    table.upsert(rows(spark, ("a", 1, 1, 10, False)))
    table.upsert(rows(spark, ("a", 1, None, 12, True)))
    assert state(spark, table) == {}
    table.upsert(rows(spark, ("a", 1, 7, 11, False)))
    assert state(spark, table) == {}
    table.upsert(rows(spark, ("a", 1, 7, 13, False)))
    assert state(spark, table) == {("a", 1): 7}


def test_repeated_load_changes_nothing(spark, table):
    load = rows(spark, ("a", 1, 1, 10, False), ("b", None, 2, 10, False))
    assert table.upsert(load) == 0
    before = state(spark, table)
    assert before == {("a", 1): 1}
    assert table.upsert(load) == 1
    assert state(spark, table) == before


def test_interrupted_load_leaves_the_table_as_it_was(spark, table):
    table.upsert(rows(spark, ("a", 1, 1, 10, False)))
    rows(spark, ("a", 1, 99, 99, False)).write.partitionBy("day").parquet(f"{table.path}/data/write=half")
    rows(spark).write.json(f"{table.path}/commits/_attempt-half")
    assert state(spark, table) == {("a", 1): 1}
    table.upsert(rows(spark, ("c", 2, 3, 10, False)))
    assert state(spark, table) == {("a", 1): 1, ("c", 2): 3}


def test_untouched_partitions_are_not_rewritten(spark, table):
    table.upsert(rows(spark, ("a", 1, 1, 10, False), ("b", 2, 2, 10, False)))
    table.upsert(rows(spark, ("b", 2, 3, 11, False)), touched=["2024-01-02"])
    first, second = table.commit(spark, 0), table.commit(spark)
    assert second.version == 1
    assert first.parts["2024-01-01"] == second.parts["2024-01-01"] and first.parts["2024-01-02"] != second.parts["2024-01-02"]
    assert {r.k for r in table.read(spark, parts={"2024-01-01"}).collect()} == {"a"}
    assert state(spark, table) == {("a", 1): 1, ("b", 2): 3}


def test_load_without_rows(spark, table):
    table.upsert(rows(spark), touched=["2024-01-01"])
    assert state(spark, table) == {}
    table.upsert(rows(spark, ("a", 1, 1, 10, False)), touched=["2024-01-01", "2024-01-02"])
    assert state(spark, table) == {("a", 1): 1}


def test_empty_table_reads_empty(spark, table):
    assert table.last_version(spark) is None
    assert table.read(spark).count() == 0


def test_buckets_spread_keys(spark):
    counts = spark.range(4000).select(bucket(["id"], 8).alias("b")).groupBy("b").agg(F.count("*").alias("n")).collect()
    assert sorted(r.b for r in counts) == list(range(8))
    assert max(r.n for r in counts) < 700


def test_rows_without_key_are_kept_apart(spark, table):
    table.upsert(rows(spark, ("a", 1, 1, 10, False), (None, 1, 2, 10, False), (None, 1, 3, 10, False), ("b", None, 4, 10, False)))
    assert state(spark, table) == {("a", 1): 1}
    assert spark.read.parquet(f"{table.path}/rejects").count() == 3


def test_unannounced_partition_fails_and_loses_nothing(spark, table):
    table.upsert(rows(spark, ("a", 1, 1, 10, False), ("b", 2, 2, 10, False)))
    with pytest.raises(ValueError, match="2024-01-02"):
        table.upsert(rows(spark, ("c", 1, 3, 10, False), ("d", 2, 4, 10, False)), touched=["2024-01-01"])
    assert state(spark, table) == {("a", 1): 1, ("b", 2): 2}


def test_second_of_two_writers_merges_with_the_first(spark, table, monkeypatch):
    """Both read the same commit; the one that commits later keeps the rows of the faster one."""
    table.upsert(rows(spark, ("a", 1, 1, 10, False)))
    write, raced = KeyedTable._write, []

    def slow(self, merged):
        out = write(self, merged)
        if not raced:
            raced.append(True)
            table.upsert(rows(spark, ("x", 1, 7, 10, False)))
        return out

    monkeypatch.setattr(KeyedTable, "_write", slow)
    assert table.upsert(rows(spark, ("y", 1, 8, 10, False))) == 2
    assert state(spark, table) == {("a", 1): 1, ("x", 1): 7, ("y", 1): 8}
    raced.clear()
    assert table.append_delta(rows(spark, ("z", 1, 9, 10, False))) == 4
    assert state(spark, table) == {("a", 1): 1, ("x", 1): 7, ("y", 1): 8, ("z", 1): 9}
    raced.clear()
    assert table.fold(spark) == 5  # the faster upsert has merged the delta, so nothing is left to fold
    assert state(spark, table) == {("a", 1): 1, ("x", 1): 7, ("y", 1): 8, ("z", 1): 9}


def test_a_writer_that_never_wins_gives_up(spark, table, monkeypatch):
    table.upsert(rows(spark, ("a", 1, 1, 10, False)))
    monkeypatch.setattr(storage, "rename_new", lambda *_: False)
    with pytest.raises(LostRace):
        table.append_delta(rows(spark, ("z", 1, 9, 10, False)))
    monkeypatch.undo()
    assert state(spark, table) == {("a", 1): 1}


def test_one_of_two_commits_with_a_number_wins(spark, table):
    table.upsert(rows(spark, ("a", 1, 1, 10, False)))
    spark.range(1).write.json(f"{table.path}/commits/_attempt-other")
    assert not storage.rename_new(spark, f"{table.path}/commits/_attempt-other", f"{table.path}/commits/version=0")
    assert state(spark, table) == {("a", 1): 1}


def files(path):
    return {os.path.join(at, name): os.stat(os.path.join(at, name)).st_size
            for at, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


def test_a_delta_writes_in_proportion_to_itself(spark, table):
    """A small batch into large partitions adds small files and leaves all others as they are."""
    table.upsert(rows(spark, *[(f"k{i}", 1 + i % 3, i, 10, False) for i in range(3000)]))
    before = files(f"{table.path}/data")
    table.append_delta(rows(spark, ("k0", 1, -1, 11, False), ("k1", 2, None, 11, True), ("new", 3, 5, 11, False)))
    after = files(f"{table.path}/data")
    assert before.items() <= after.items() and len(after) > len(before)
    assert sum(after.values()) - sum(before.values()) < sum(before.values()) / 2
    now = state(spark, table)
    assert len(now) == 3000 and now["k0", 1] == -1 and ("k1", 2) not in now and now["new", 3] == 5
    table.fold(spark)
    assert state(spark, table) == now
    assert all(at.deltas == () for at in table.commit(spark).parts.values())


def test_deltas_merge_by_order_not_by_arrival(spark, table):
    table.append_delta(rows(spark, ("a", 1, 1, 10, False), ("a", 1, 0, 9, False)))
    table.append_delta(rows(spark, ("a", 1, None, 12, True)))
    table.append_delta(rows(spark, ("a", 1, 7, 11, False), ("b", 1, 2, 1, False)))
    assert state(spark, table) == {("b", 1): 2}
    table.upsert(rows(spark, ("b", 1, 3, 0, False), ("c", 1, 4, 1, False)))  # merges deltas as well
    assert state(spark, table) == {("b", 1): 2, ("c", 1): 4}
    assert table.commit(spark).parts["2024-01-01"].deltas == ()


def test_fold_leaves_partitions_with_few_deltas(spark, table):
    table.append_delta(rows(spark, ("a", 1, 1, 1, False), ("b", 2, 1, 1, False)))
    table.append_delta(rows(spark, ("a", 1, 2, 2, False)))
    table.fold(spark, least=2)
    parts = table.commit(spark).parts
    assert parts["2024-01-01"].deltas == () and len(parts["2024-01-02"].deltas) == 1
    assert state(spark, table) == {("a", 1): 2, ("b", 2): 1}
    assert table.fold(spark, least=2) == table.last_version(spark)  # nothing to do, no new commit


def test_a_repeated_batch_is_skipped(spark, table, monkeypatch):
    load = rows(spark, ("a", 1, 1, 10, False))
    assert table.append_delta(load, "feed", 3) == 0
    before = files(table.path)
    assert table.append_delta(load, "feed", 3) == 0 and table.append_delta(load, "feed", 2) == 0
    assert files(table.path) == before
    assert table.append_delta(rows(spark), "feed", 4) == 1  # an empty batch counts
    assert table.append_delta(load, "other", 0) == 2
    assert table.commit(spark).batches == {"feed": 4, "other": 0}
    # A crash between write and commit: the batch comes again and counts once.
    monkeypatch.setattr(KeyedTable, "_publish", lambda *_: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        table.append_delta(rows(spark, ("c", 1, 5, 10, False)), "feed", 5)
    monkeypatch.undo()
    assert state(spark, table) == {("a", 1): 1}
    assert table.append_delta(rows(spark, ("c", 1, 5, 10, False)), "feed", 5) == 3
    assert state(spark, table) == {("a", 1): 1, ("c", 1): 5}


def test_changes_between_versions(spark, table):
    def changes(old, new):
        return {(r.k, r.day.day): (r.before and r.before.v, r.after and r.after.v)
                for r in table.changes_between(spark, old, new).collect()}

    table.upsert(rows(spark, ("a", 1, 1, 10, False), ("b", 1, 2, 10, False), ("c", 2, 3, 10, False)))
    table.append_delta(rows(spark, ("a", 1, 5, 11, False), ("b", 1, 9, 1, False), ("n", 2, 4, 10, False)))
    table.append_delta(rows(spark, ("c", 2, None, 11, True), ("z", 3, None, 1, True)))
    table.fold(spark)
    table.replace(rows(spark, ("a", 1, 5, 11, False)), ["2024-01-01", "2024-01-02"])
    assert changes(None, 0) == {("a", 1): (None, 1), ("b", 1): (None, 2), ("c", 2): (None, 3)}
    assert changes(0, 1) == {("a", 1): (1, 5), ("n", 2): (None, 4)}
    assert changes(0, 2) == {("a", 1): (1, 5), ("n", 2): (None, 4), ("c", 2): (3, None)}
    assert changes(2, 3) == {}
    assert changes(1, 4) == {("b", 1): (2, None), ("c", 2): (3, None), ("n", 2): (4, None)}
    assert changes(4, 4) == {}


def test_replaced_partitions_may_come_out_empty(spark, table):
    table.upsert(rows(spark, ("a", 1, 1, 10, False), ("b", 2, 2, 10, False)))
    table.replace(rows(spark, ("c", 3, 3, 10, False)), ["2024-01-01", "2024-01-03", "2024-01-09"], "source", 8)
    assert state(spark, table) == {("b", 2): 2, ("c", 3): 3}
    assert set(table.commit(spark).parts) == {"2024-01-02", "2024-01-03"} and table.commit(spark).batches == {"source": 8}
    with pytest.raises(ValueError, match="2024-01-02"):
        table.replace(rows(spark, ("c", 2, 3, 10, False)), ["2024-01-01"])


def test_several_partition_columns(spark, tmp_path):
    columns = "k string, y string, m string, v int, at int"
    table = KeyedTable(str(tmp_path / "t"), schemas.struct(columns), ("k", "y", "m"), ("at",), ("y", "m"))

    def load(*values):
        return spark.createDataFrame(list(values), columns)

    table.upsert(load(("a", "2023", "12", 1, 1), ("a", "2024", "1", 2, 1), ("a", "2024", "2", 3, 1)))
    before = files(f"{table.path}/data")
    table.upsert(load(("a", "2024", "1", 9, 2), ("b", "2024", "1", 4, 2)), ["2024/1"])
    assert before.items() <= files(f"{table.path}/data").items()
    assert table.commit(spark, 0).parts["2024/2"] == table.commit(spark).parts["2024/2"]
    assert sorted((r.k, r.y, r.m, r.v) for r in table.read(spark).collect()) == [
        ("a", "2023", "12", 1), ("a", "2024", "1", 9), ("a", "2024", "2", 3), ("b", "2024", "1", 4)]
    assert sorted(r.v for r in table.read(spark, {"2024"}).collect()) == [3, 4, 9]
    assert sorted(r.v for r in table.read(spark, {"2024/1", "2023"}).collect()) == [1, 4, 9]


def test_expired_versions_are_removed(spark, table):
    for at in range(4):
        table.upsert(rows(spark, ("a", 1, at, at, False), ("b", 2 + at, at, at, False)))
    table.expire(spark, keep=2, older_than=dt.timedelta(days=1))
    assert table.last_version(spark) == 3 and len(storage.children(spark, f"{table.path}/data")) == 4
    table.expire(spark, keep=1, older_than=-dt.timedelta(days=1))
    now = state(spark, table)
    assert now == {("a", 1): 3, ("b", 2): 0, ("b", 3): 1, ("b", 4): 2, ("b", 5): 3}
    assert table.commit(spark).version == 3 and "version=2" not in storage.children(spark, f"{table.path}/commits")


def test_first_load_reads_its_source_once(spark, table):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    load = rows(spark, *((f"k{i}", i % 3 + 1, i, 10, False) for i in range(60))).mapInArrow(counted, COLUMNS)
    table.upsert(load)
    assert read.value == 60
    assert len(state(spark, table)) == 60
    assert spark.read.parquet(f"{table.path}/rejects").count() == 0


def test_first_load_keeps_the_newest_row_of_repeated_keys_alone(spark, table):
    load = rows(spark, *((f"k{i}", i % 3 + 1, i, 10, False) for i in range(40)), ("k0", 1, 100, 11, False), ("k0", 1, 99, 10, False),
                ("k1", 2, 7, 12, True), ("k2", 3, 2, 10, False), (None, 1, 5, 10, False))
    table.upsert(load, gathered=True)
    found = state(spark, table)
    assert found == {(f"k{i}", i % 3 + 1): 100 if i == 0 else i for i in range(40) if i != 1}
    assert table.read(spark).count() == 39
    assert [name for name in storage.children(spark, f"{table.path}/aside")] == []
    assert len(storage.children(spark, f"{table.path}/data")) == 1
    assert spark.read.parquet(f"{table.path}/rejects").count() == 1
