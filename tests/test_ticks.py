"""Index ticks: unwrapping, local days, and the stream against the batch."""

import datetime as dt
import json

import pytest
from ledgerlake.operators import tables
from ledgerlake.plans import gold
from ledgerlake.schemas import TICK_CLASS, TICK_COLUMNS
from ledgerlake.sources import bindings
from ledgerlake.sources.streams import FileStream
from ledgerlake.streaming import refresh, ticks


def message(code, time, total, kind=TICK_CLASS):
    body = {"Header": {"MessageType": "index", "Last_updated": time}, "IndexCode": code, "TotalValuesTraded": {"value": total}}
    return json.dumps({"type_url": f"type.googleapis.com/{kind}", "value": body})


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def turnover(rows):
    return {row.C_DATE.isoformat(): row.total_market_value for row in rows.collect()}


def test_other_classes_and_broken_text_are_left_out(spark):
    text = lines(spark, message("A", "2024-01-01T01:00:00Z", 5), message("A", "2024-01-01T02:00:00Z", 6, "other.Message"), "broken", '{"type_url": "noslash"}')
    flat = ticks.parse_ticks(text)
    assert tuple(flat.columns) == TICK_COLUMNS
    assert [(row.IndexCode, row.TotalValuesTraded, row.Last_updated) for row in flat.collect()] == [("A", 5, dt.datetime(2024, 1, 1, 1))]


def test_ticks_around_local_midnight_belong_to_two_days(spark):
    text = lines(spark, message("A", "2024-01-01T16:59:00Z", 5), message("A", "2024-01-01T17:01:00Z", 7), message("B", "2024-01-01T16:00:00Z", 1), message("A", "2024-01-01T10:00:00Z", 50))
    assert turnover(gold.market_turnover(ticks.parse_ticks(text))) == {"2024-01-01": 6, "2024-01-02": 7}


def test_equal_times_take_the_larger_total(spark):
    text = lines(spark, message("A", "2024-01-01T01:00:00Z", 5), message("A", "2024-01-01T01:00:00Z", 8))
    assert turnover(gold.market_turnover(ticks.parse_ticks(text))) == {"2024-01-01": 8}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stream_over_several_batches_equals_batch(spark, tmp_path, folder, zone):
    wire, out, checkpoint = (str(tmp_path / name) for name in ("wire", "out", "checkpoint"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = bindings.tick_wire(spark, folder)
        early = "get_json_object(value, '$.value.Time') < '2024-01-12'"
        for part in (early, f"NOT {early}"):
            text.where(part).write.mode("append").text(wire)
            ticks.start_turnover(spark, FileStream(wire), out, checkpoint, "1 hour").awaitTermination()
        streamed = turnover(spark.read.parquet(out))
        batch = turnover(gold.market_turnover(ticks.parse_ticks(text)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    last = max(batch)
    assert streamed == {day: total for day, total in batch.items() if day != last}


def test_late_tick_is_counted_and_its_day_refreshed(spark, tmp_path):
    wire, out, checkpoint, table, stored = (str(tmp_path / name) for name in ("wire", "out", "checkpoint", "table", "stored"))

    def run(*texts):
        lines(spark, *texts).write.mode("append").text(wire)
        query = ticks.start_turnover(spark, FileStream(wire), out, checkpoint, "1 hour")
        query.awaitTermination()
        ticks.start_tick_table(spark, FileStream(wire), table, checkpoint + "-table").awaitTermination()
        return ticks.late_ticks(query)

    assert run(message("A", "2024-01-01T01:00:00Z", 5), message("A", "2024-01-03T01:00:00Z", 1)) == 0
    assert run(message("A", "2024-01-01T02:00:00Z", 9), message("A", "2024-01-03T02:00:00Z", 2)) == 1
    assert turnover(spark.read.parquet(out)) == {"2024-01-01": 5}
    tables.overwrite(spark.read.parquet(out), stored, ["C_DATE"])
    refresh.refresh_turnover(spark.read.parquet(table), stored, dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert turnover(spark.read.parquet(stored)) == {"2024-01-01": 9}
