"""Derived tables kept up to date by differences of versions, the index of days, updates by predicate and log compaction."""

import datetime as dt
import os
from collections import Counter
from decimal import Decimal

import pytest
from ledgerlake import schemas, specs
from ledgerlake.operators import storage, tables
from ledgerlake.operators.dayindex import DayIndex
from ledgerlake.operators.keyed import KeyedTable, LostRace
from ledgerlake.plans import gold
from ledgerlake.streaming import cdc, refresh, sums
from ledgerlake.streaming.compaction import CompactedLog
from ledgerlake.sources.streams import FileStream
from pyspark.sql import functions as F

LOADED = "at int, partition_date date"
FACTS = {
    "margin": ("k string, C_ACCOUNT_CODE string, C_TRADING_DATE timestamp_ntz, C_INTERM_LOAN decimal(15,0), "
               f"C_INTERM_LOAN_OUT decimal(15,0), C_OUTTERM_LOAN decimal(15,0), C_OUTTERM_LOAN_OUT decimal(15,0), {LOADED}"),
    "debit": ("k string, C_ACCOUNT_CODE string, C_TRANSACTION_DATE timestamp_ntz, C_INTERM_BALANCE decimal(15,0), "
              "C_INTERM_CASH_OUT decimal(15,0), C_OUTTERM_BALANCE decimal(15,0), C_OUTTERM_CASH_OUT decimal(15,0), "
              f"C_MBS_EXPIRE_DEBIT decimal(15,0), C_TLO_COL_1 decimal(15,0), {LOADED}"),
    "advances": f"k string, C_ACCOUNT_CODE string, C_WITHDRAW_DATE timestamp_ntz, C_CASH_VOLUME decimal(38,10), {LOADED}",
    "deals": ("k string, C_ACCOUNT_CODE string, C_TRANSACTION_DATE timestamp_ntz, C_MATCHED_PRICE decimal(38,10), "
              f"C_MATCHED_VOLUME decimal(38,10), {LOADED}"),
}


def jan(day):
    return dt.date(2024, 1, day)


def at(day):
    return dt.datetime(2024, 1, day, 9)


@pytest.fixture
def facts(tmp_path):
    return {name: KeyedTable(f"{tmp_path}/{name}", schemas.struct(columns), ("k", "partition_date"), ("at",), "partition_date")
            for name, columns in FACTS.items()}


def advances(spark, *rows):
    return spark.createDataFrame(
        [(k, code, at(day), Decimal(value), n, jan(stored)) for k, code, day, value, n, stored in rows], FACTS["advances"])


def account_days(spark, path):
    return {(r.C_ACCOUNT_CODE, r.C_DATE.day): int(r.C_UTTB) for r in spark.read.parquet(path).collect()}


def test_a_moved_row_leaves_its_day(spark, facts, tmp_path):
    """The day that has lost its only row goes; a row of it that stays is recomputed; a repeated run changes nothing."""
    path, seen = f"{tmp_path}/gold", f"{tmp_path}/seen"
    product = refresh.account_days_product(facts, path)
    assert refresh.refresh_product(spark, product, seen) == {}
    facts["advances"].upsert(advances(spark, ("a", "x", 3, 100, 1, 5), ("b", "x", 8, 7, 1, 9), ("c", "x", 8, 5, 1, 9)))
    refresh.refresh_product(spark, product, seen)
    assert account_days(spark, path) == {("x", 3): 100, ("x", 8): 12}
    facts["advances"].append_delta(advances(spark, ("a", "x", 4, 100, 2, 5), ("c", "y", 8, 5, 2, 9)))
    facts["margin"].upsert(spark.createDataFrame([("m", "x", at(3), None, None, None, None, 1, jan(3))], FACTS["margin"]).limit(0))
    for _ in range(2):
        assert refresh.refresh_product(spark, product, seen)["advances"] == 1
        assert account_days(spark, path) == {("x", 4): 100, ("x", 8): 7, ("y", 8): 5}
    assert "partition_day=2024-01-03" not in storage.children(spark, path)


def test_a_run_that_broke_off_is_repeated(spark, facts, tmp_path, monkeypatch):
    path, seen = f"{tmp_path}/gold", f"{tmp_path}/seen"
    product = refresh.account_days_product(facts, path)
    facts["advances"].upsert(advances(spark, ("a", "x", 3, 100, 1, 5)))
    refresh.refresh_product(spark, product, seen)
    facts["advances"].upsert(advances(spark, ("a", "x", 4, 100, 2, 5)))
    monkeypatch.setattr(storage, "remove", lambda *_: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        refresh.refresh_product(spark, product, seen)
    monkeypatch.undo()
    refresh.refresh_product(spark, product, seen)
    assert account_days(spark, path) == {("x", 4): 100}


def test_only_changed_partitions_are_read(spark, facts):
    table = facts["advances"]
    table.upsert(advances(spark, *((f"k{day}", "x", day, 1, 1, day) for day in range(1, 11))))
    table.append_delta(advances(spark, ("k3", "x", 3, 2, 2, 3)))
    files = table.changes_between(spark, 0, 1).inputFiles()
    assert files and all("partition_date=2024-01-03" in file for file in files)


def test_index_lists_the_partitions_of_a_day(spark, facts, tmp_path):
    """Only folders that may hold rows of the wanted days are read; moved rows leave a superfluous pair at most."""
    table, index = facts["advances"], DayIndex(f"{tmp_path}/days", "C_WITHDRAW_DATE")
    assert index.parts(spark, jan(1), jan(5)) is None
    loads = [[("a", "x", 3, 100, 1, 5), ("b", "x", 3, 1, 1, 9)], [("c", "x", 4, 7, 1, 9), ("d", "x", 20, 7, 1, 21)], [("a", "x", 6, 100, 2, 5)]]
    for rows in loads:
        load = advances(spark, *rows)
        index.add(load)
        table.upsert(load)
    assert index.parts(spark, jan(3), jan(4)) == {"2024-01-05", "2024-01-09"}
    assert index.parts(spark, jan(4), jan(5)) == {"2024-01-09"}
    assert index.parts(spark, jan(10), jan(12)) == set()
    rows = table.read(spark, index.parts(spark, jan(4), jan(5)))
    assert {file.split("partition_date=")[1][:10] for file in rows.inputFiles()} == {"2024-01-09"}
    for day in range(1, 25):
        window = (F.col("C_WITHDRAW_DATE") >= F.lit(at(day).date())) & (F.col("C_WITHDRAW_DATE") < F.lit(at(day).date() + dt.timedelta(days=1)))
        chosen = table.read(spark, index.parts(spark, jan(day), jan(day + 1))).where(window)
        assert Counter(r.k for r in chosen.collect()) == Counter(r.k for r in table.read(spark).where(window).collect())
    index.rebuild(table.read(spark))
    assert index.parts(spark, jan(3), jan(4)) == {"2024-01-09"}


# --- signed sums ---

LOG = ("PK_FRONT_DEAL string, op string, C_ACCOUNT_CODE string, C_MATCHED_PRICE double, C_MATCHED_VOLUME double, "
       "partition_date date, updated_at timestamp_ntz, ts_ms bigint, scn decimal(38,0), ts_ns bigint")


def log(spark, *rows):
    return spark.createDataFrame(
        [(k, op, code, price, volume, jan(day), at(day), ms, None, None) for k, op, code, price, volume, day, ms in rows], LOG)


@pytest.fixture
def summed(tmp_path):
    return sums.day_state_table(f"{tmp_path}/state"), sums.account_sums_table(f"{tmp_path}/sums")


def test_sums_follow_updates_moves_deletes_and_late_changes(spark, summed):
    state, totals = summed
    batches = [
        [("1", "c", "x", 2.0, 10.0, 1, 10), ("2", "c", "x", 3.0, 1.0, 1, 10), ("3", "c", "y", None, 1.0, 1, 10), ("4", "c", "z", 1.0, 1.0, 2, 50)],
        [("1", "u", "y", 2.5, 10.0, 1, 12), ("2", "d", None, None, None, 1, 13)],  # a move and a delete: x has no deals left
        [("2", "u", "x", 9.0, 9.0, 1, 11), ("1", "u", "x", 9.0, 9.0, 1, 9)],  # late changes lose
        [("2", "u", "x", 4.0, 1.0, 2, 60), ("4", "d", None, None, None, 2, 61)],  # the next day
        [("1", "u", "y", 2.5, 10.0, 1, 12)],  # fed again
    ]
    everything = log(spark).limit(0)
    for rows in batches:
        sums.add_day_changes(log(spark, *rows), state)
        everything = everything.unionByName(log(spark, *rows))
        for _ in range(2):
            sums.update_account_sums(spark, state, totals)
        for day in (1, 2, 3):
            want = {r.C_ACCOUNT_CODE: r.C_GTGD for r in gold.front_data(everything, jan(day)).collect()}
            assert {r.C_ACCOUNT_CODE: r.C_GTGD for r in sums.front_data(spark, totals, jan(day)).collect()} == want
    assert {(r.C_ACCOUNT_CODE, r.deals) for r in totals.read(spark, {"2024-01-01"}).collect()} == {("y", 2)}


def test_batches_that_change_nothing_write_nothing(spark, summed):
    state, totals = summed
    sums.add_day_changes(log(spark, ("1", "c", "x", 2.0, 10.0, 1, 10)), state, "feed", 0)
    sums.update_account_sums(spark, state, totals)
    version = totals.last_version(spark)
    sums.add_day_changes(log(spark, ("1", "c", "x", 2.0, 10.0, 1, 10)), state, "feed", 0)
    sums.update_account_sums(spark, state, totals)
    assert totals.last_version(spark) == version
    state.fold(spark)  # another version of the state with the same rows
    sums.update_account_sums(spark, state, totals)
    assert [(r.C_ACCOUNT_CODE, int(r.C_GTGD)) for r in totals.read(spark).collect()] == [("x", 20)]


def test_two_runs_at_a_time_count_once(spark, summed, monkeypatch):
    state, totals = summed
    sums.add_day_changes(log(spark, ("1", "c", "x", 2.0, 10.0, 1, 10)), state)
    append, raced = KeyedTable.append_delta, []

    def slow(self, *args, **named):
        if self.path == totals.path and not raced:
            raced.append(True)
            sums.add_day_changes(log(spark, ("2", "c", "x", 1.0, 1.0, 1, 10)), state)
            sums.update_account_sums(spark, state, totals)
        return append(self, *args, **named)

    monkeypatch.setattr(KeyedTable, "append_delta", slow)
    sums.update_account_sums(spark, state, totals)
    monkeypatch.undo()
    sums.update_account_sums(spark, state, totals)
    assert [(int(r.C_GTGD), r.deals) for r in totals.read(spark).collect()] == [(21, 2)]


def test_a_delta_of_an_older_commit_is_refused(spark, summed):
    _, totals = summed
    row = spark.createDataFrame([("x", jan(1), Decimal(1), 1, 1, False)], totals.schema)
    seen = totals.commit(spark)
    totals.append_delta(row)
    with pytest.raises(LostRace):
        totals.append_delta(row, onto=seen)


# --- account dimension ---


def test_dimension_follows_codes(spark, tmp_path):
    feed = specs.ACCOUNT_FEED
    state, dim = cdc.state_table(f"{tmp_path}/state", feed), sums.account_dim_table(f"{tmp_path}/dim")

    def batch(*rows):
        columns = "PK_ACCOUNT string, op string, ts_ms bigint, C_ACCOUNT_CODE string, C_ACCOUNT_BRANCH_CODE string"
        given = spark.createDataFrame(list(rows), columns)
        missing = [field for field in (*feed.row.fields, *schemas.struct("scn decimal(38,0), ts_ns bigint").fields) if field.name not in given.columns]
        cdc.apply_changes(given.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}), feed, state, 4)
        for _ in range(2):
            sums.update_account_dim(spark, state, dim, 4)
        whole = gold.back_account_dim(state.read(spark))
        stored = {(r.C_ACCOUNT_CODE, r.C_BRANCH_NAME) for r in sums.account_dim(spark, dim).collect()}
        assert stored == {(r.C_ACCOUNT_CODE, r.C_BRANCH_NAME) for r in whole.collect()}
        return {code for code, _ in stored}

    assert batch(("1", "c", 1, "aaaaaa1", "17"), ("2", "c", 1, "bbbbbb1", "1"), ("3", "c", 1, "cccccc1", "1")) == {"aaaaaa1", "bbbbbb1", "cccccc1"}
    assert batch(("1", "u", 2, "bbbbbb1", "17"), ("2", "u", 2, "aaaaaa1", "1")) == {"aaaaaa1", "bbbbbb1", "cccccc1"}  # they swap
    assert batch(("3", "u", 3, "aaaaaa1", "17")) == {"aaaaaa1", "bbbbbb1"}  # two share a code
    assert batch(("3", "d", 4, None, None), ("1", "d", 4, None, None)) == {"aaaaaa1"}
    assert batch(("9", "c", 5, None, "1")) == {"aaaaaa1"}
    dim.fold(spark)
    assert batch(("2", "u", 6, "dddddd1", "1")) == {"dddddd1"}


# --- streams ---


def test_a_batch_that_comes_again_is_skipped(spark, tmp_path, folder):
    """The crash between the commit of the state and that of the stream."""
    from ledgerlake.sources import bindings

    bindings.deal_wire(spark, folder).limit(300).write.text(f"{tmp_path}/wire")
    table = cdc.state_table(f"{tmp_path}/state", specs.DEAL_FEED)

    def run():
        cdc.start_apply_changes(spark, FileStream(f"{tmp_path}/wire"), specs.DEAL_FEED, table, f"{tmp_path}/checkpoint", 4).awaitTermination()

    run()
    assert table.last_version(spark) == 0
    for name in os.listdir(f"{tmp_path}/checkpoint/commits"):
        os.remove(f"{tmp_path}/checkpoint/commits/{name}")
    run()
    assert table.last_version(spark) == 0 and [*table.commit(spark).batches.values()] == [0]
    bindings.deal_wire(spark, folder).limit(10).write.mode("append").text(f"{tmp_path}/wire")
    run()
    assert table.last_version(spark) == 1 and [*table.commit(spark).batches.values()] == [1]


def test_compaction_keeps_the_log_and_its_readers(spark, tmp_path):
    columns = "k int, partition_date date"
    source, path = f"{tmp_path}/source", f"{tmp_path}/log"

    def deliver(*rows):
        spark.createDataFrame([(k, jan(day)) for k, day in rows], columns).repartition(3).write.mode("append").parquet(source)
        stream = spark.readStream.schema(columns).parquet(source).writeStream.format("parquet").partitionBy("partition_date")
        stream.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start(path).awaitTermination()

    def follow():
        stream = spark.readStream.schema(columns).parquet(path).writeStream.format("parquet")
        stream.option("checkpointLocation", f"{tmp_path}/follower").trigger(availableNow=True).start(f"{tmp_path}/copy").awaitTermination()
        return sorted(r.k for r in spark.read.parquet(f"{tmp_path}/copy").collect())

    compacted = CompactedLog(path, f"{tmp_path}/compacted")
    deliver(*((k, 1 + k % 3) for k in range(30)))
    assert follow() == [*range(30)]
    deliver(*((k, 1 + k % 3) for k in range(30, 60)))
    small = len(compacted.read(spark).inputFiles())
    assert compacted.compact(spark, jan(3)) == ["2024-01-01", "2024-01-02"]
    files = compacted.read(spark).inputFiles()
    assert len(files) < small and sum("partition_date=2024-01-01" in file for file in files) == 1
    deliver((60, 1), (61, 4))  # one for a closed day
    assert sorted(r.k for r in compacted.read(spark).collect()) == [*range(62)]
    assert follow() == [*range(62)]
    assert compacted.compact(spark, jan(3)) == []  # one file more is left for later
    assert compacted.compact(spark, jan(3), least=1) == ["2024-01-01"]
    files = compacted.read(spark).inputFiles()
    assert sum("partition_date=2024-01-01" in file for file in files) == 1
    assert sorted((r.k, r.partition_date.day) for r in compacted.read(spark).collect()) == sorted([*((k, 1 + k % 3) for k in range(60)), (60, 1), (61, 4)])


# --- updates by predicate ---


def files_of(path):
    return {os.path.join(at, name): os.stat(os.path.join(at, name)).st_mtime_ns
            for at, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


def test_update_rewrites_the_partitions_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, None if i == 7 else i % 5, y, m) for i in range(40) for y, m in [("2023", i % 3), ("2024", i % 2)]]
    tables.overwrite(spark.createDataFrame(rows, "k int, v int, y string, m int"), path, ["y", "m"])
    before = files_of(path)
    hit = (F.col("v") == 3) & (F.col("y") == "2023") & (F.col("m") > 0)
    assert tables.update_where(spark, path, ["y", "m"], hit, {"v": F.col("k") * 100}) == [(2023, 1), (2023, 2)]
    after = files_of(path)
    kept = {file: time for file, time in before.items() if "y=2023/m=1" not in file and "y=2023/m=2" not in file}
    assert kept.items() <= after.items() and not {file for file in before if file not in kept} & set(after)
    want = Counter((k, k * 100 if v == 3 and y == "2023" and m > 0 else v, int(y), m) for k, v, y, m in rows)
    assert Counter((r.k, r.v, r.y, r.m) for r in spark.read.parquet(path).collect()) == want
    assert tables.update_where(spark, path, ["y", "m"], F.col("v") == 77, {"v": F.lit(1)}) == []
    with pytest.raises(ValueError, match="cannot be updated"):
        tables.update_where(spark, path, ["y", "m"], hit, {"m": F.lit(1)})
