"""Change records on hand-made text."""

import datetime as dt
import json

import pytest
from ledgerlake.sources.streams import FileStream, KafkaStream
from ledgerlake.specs import ACCOUNT_FEED, DEAL_FEED
from ledgerlake.streaming import cdc


def record(op, ms, key=47926470.0, scn="1", ns=None, **row):
    row = {"PK_FRONT_DEAL": key, "C_ACCOUNT_CODE": "9091331", **row}
    before, after = (row, None) if op == "d" else (None, row)
    return json.dumps({"schema": {}, "payload": {"before": before, "after": after, "op": op, "ts_ms": ms, "ts_ns": ns, "source": {"scn": scn}}})


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


@pytest.fixture
def state(spark, tmp_path):
    feed = DEAL_FEED.only("C_ACCOUNT_CODE", "C_MATCHED_PRICE")
    table = cdc.state_table(str(tmp_path / "state"), feed)

    def apply(*texts):
        cdc.apply_changes(cdc.valid_changes(lines(spark, *texts), feed), feed, table, 4)
        return {row.PK_FRONT_DEAL: row.C_MATCHED_PRICE for row in table.read(spark).collect()}

    return apply


def test_key_has_no_exponent(state):
    assert state(record("c", 1000, C_MATCHED_PRICE=5.0)) == {"47926470": 5.0}


def test_last_change_within_a_second_wins(state):
    changes = [record("u", 1002, C_MATCHED_PRICE=3.0), record("c", 1000, C_MATCHED_PRICE=1.0), record("u", 1001, C_MATCHED_PRICE=2.0)]
    assert state(*changes) == {"47926470": 3.0}


def test_equal_time_is_settled_by_the_log_position(state):
    assert state(record("u", 1, scn="9", C_MATCHED_PRICE=9.0), record("u", 1, scn="10", C_MATCHED_PRICE=10.0)) == {"47926470": 10.0}


def test_changes_of_one_log_position_go_by_the_finer_time(state):
    later = record("u", 1, ns=1_000_009, C_MATCHED_PRICE=1.0)
    assert state(later, record("u", 1, ns=1_000_008, C_MATCHED_PRICE=9.0)) == {"47926470": 1.0}


def test_snapshot_row_is_an_upsert(state):
    assert state(record("r", 1, C_MATCHED_PRICE=4.0)) == {"47926470": 4.0}


def test_delete_after_update_and_late_older_update(state):
    assert state(record("u", 5, C_MATCHED_PRICE=1.0), record("d", 6)) == {}
    assert state(record("u", 4, C_MATCHED_PRICE=2.0)) == {}
    assert state(record("u", 7, C_MATCHED_PRICE=3.0)) == {"47926470": 3.0}
    assert state(record("u", 6, C_MATCHED_PRICE=8.0)) == {"47926470": 3.0}


def test_same_batch_twice(state):
    batch = [record("c", 1, C_MATCHED_PRICE=1.0), record("c", 1, key=2.0, C_MATCHED_PRICE=2.0), record("d", 2, key=2.0)]
    assert state(*batch) == state(*batch) == {"47926470": 1.0}


def test_rejects(spark):
    bad = ["no json", "{}", record("x", 1), record("c", None), record("c", 1, key=None)]
    text = lines(spark, record("c", 1), *bad)
    assert sorted(row.value for row in cdc.rejects(text, DEAL_FEED).collect()) == sorted(bad)
    assert cdc.valid_changes(text, DEAL_FEED).count() == 1


def test_broken_fields_are_rejected(spark):
    good = record("c", 1, C_MATCHED_PRICE=2.5)
    bad = [record("c", 1, C_MATCHED_PRICE="abc"), good[:-3]]
    assert sorted(row.value for row in cdc.rejects(lines(spark, good, *bad), DEAL_FEED).collect()) == sorted(bad)
    times = [account("u", 5), account("u", 6, C_CREATE_TIME="soon")]
    assert [row.value for row in cdc.rejects(lines(spark, *times), ACCOUNT_FEED).collect()] == times[1:]


def test_number_of_buckets_stays_with_the_table(spark, tmp_path):
    table = cdc.state_table(str(tmp_path / "state"), DEAL_FEED)
    cdc.apply_changes(cdc.valid_changes(lines(spark, record("c", 1)), DEAL_FEED), DEAL_FEED, table, 2)
    with pytest.raises(ValueError, match="2 buckets"):
        cdc.apply_changes(cdc.valid_changes(lines(spark, record("u", 2)), DEAL_FEED), DEAL_FEED, table, 4)


def account(op, ms, **row):
    row = {"PK_ACCOUNT": "A1", "C_ACCOUNT_CODE": "9091331", "C_CREATE_TIME": "2020-05-01T08:00:00", **row}
    before, after = (row, None) if op == "d" else (None, row)
    return json.dumps({"payload": {"before": before, "after": after, "op": op, "ts_ms": ms, "source": {"scn": "1"}}})


def test_change_log_times(spark):
    at = 1762746854835
    log = cdc.change_log(
        cdc.valid_changes(lines(spark, account("c", at), account("u", at + 1), account("d", at + 2)), ACCOUNT_FEED),
        ACCOUNT_FEED,
    )
    rows = {row.op: row for row in log.collect()}
    updated = dt.datetime(2025, 11, 10, 10, 54, 14, 835000)
    created = dt.datetime(2020, 5, 1, 8)
    assert (rows["c"].created_at, rows["c"].updated_at) == (updated, updated)
    assert (rows["u"].created_at, rows["d"].created_at) == (created, created)
    assert rows["d"].C_ACCOUNT_CODE is None and rows["d"].PK_ACCOUNT == "A1"
    assert rows["c"].partition_date == dt.date(2025, 11, 10)
    assert "C_CREATE_TIME" not in log.columns


def test_deal_log_has_a_creation_time_for_creates_only(spark):
    changes = cdc.valid_changes(lines(spark, record("c", 1000), record("u", 2000)), DEAL_FEED)
    created = {row.op: row.created_at for row in cdc.change_log(changes, DEAL_FEED).collect()}
    assert created == {"c": dt.datetime(1970, 1, 1, 8, 0, 1), "u": None}


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    wire, log, checkpoint = (str(tmp_path / name) for name in ("wire", "log", "checkpoint"))
    for batch in ([record("c", 1), record("u", 2)], [record("d", 3)], []):
        if batch:
            lines(spark, *batch).write.mode("append").text(wire)
        cdc.start_change_log(spark, FileStream(wire, files_per_trigger=1), DEAL_FEED, log, checkpoint).awaitTermination()
    assert sorted(row.ts_ms for row in spark.read.parquet(log).collect()) == [1, 2, 3]


def test_reject_stream(spark, tmp_path):
    wire, out, checkpoint = (str(tmp_path / name) for name in ("wire", "out", "checkpoint"))
    lines(spark, record("c", 1), "broken").write.text(wire)
    cdc.start_rejects(spark, FileStream(wire), DEAL_FEED, out, checkpoint).awaitTermination()
    assert [row.value for row in spark.read.text(out).collect()] == ["broken"]


def test_feed_of_few_columns():
    feed = ACCOUNT_FEED.only("C_CHANNEL")
    assert [column.split()[0] for column in feed.columns.split(", ")] == ["PK_ACCOUNT", "C_CREATE_TIME", "C_CHANNEL"]


def test_plain_rows(spark):
    text = lines(spark, '{"PK_FRONT_DEAL": 47926470.0, "C_MATCHED_PRICE": 2.5}', "broken")
    rows = [(row.PK_FRONT_DEAL, row.C_MATCHED_PRICE) for row in cdc.parse_rows(text, DEAL_FEED).collect()]
    assert rows == [("47926470", 2.5), (None, None)]


def test_kafka_options():
    topic = KafkaStream("host:1", subscribe="t", starting="earliest", offsets_per_trigger=5000).reader_options()
    assert topic == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5000",
    }
    assert KafkaStream("host:1", assign='{"t":[0]}').reader_options()["assign"] == '{"t":[0]}'
    with pytest.raises(ValueError, match="either"):
        KafkaStream("host:1").reader_options()
