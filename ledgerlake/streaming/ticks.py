"""Index ticks: unwrapping, flattening, the stored tick table and the streaming daily turnover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions.times import MARKET_ZONE, as_instant, as_utc, to_local
from ledgerlake.operators.projections import computed_once
from ledgerlake.schemas import TICK_CLASS, TICK_COLUMNS, TICK_COUNTS, TICK_VALUES, tick_body
from ledgerlake.sources.streams import StreamSource

HEADER = ("MessageType", "TradingSession", "CreatedAt", "Last_updated")
INSTANTS = ("CreatedAt", "Last_updated", "Time")


def message_class(type_url: Column) -> Column:
    """Message class of a type URL: the part after the first slash, NULL if there is none."""
    return F.get(F.split(type_url, "/"), F.lit(1))


def parse_ticks(lines: DataFrame, wanted: str = TICK_CLASS) -> DataFrame:
    """Flat ticks of JSON messages ``{type_url, value}`` of the wanted class."""
    message = F.from_json("value", f"type_url string, value {tick_body().simpleString()}")
    messages = lines.select(computed_once(message).alias("message")).select(
        "message.type_url", F.col("message.value").alias("body")
    )
    return flatten_ticks(messages.where(message_class(F.col("type_url")) == wanted))


def parse_tick_bytes(records: DataFrame, descriptor: str, wanted: str = TICK_CLASS) -> DataFrame:
    """Flat ticks of protobuf ``Any`` messages; needs Spark's protobuf package and a descriptor file that the
    executors can read."""
    from pyspark.sql.protobuf.functions import from_protobuf

    message = from_protobuf("value", "google.protobuf.Any", descriptor)
    outer = records.select(computed_once(message).alias("message"))
    bodies = outer.where(message_class(F.col("message.type_url")) == wanted)
    return flatten_ticks(bodies.select(from_protobuf("message.value", wanted, descriptor).alias("body")))


def _tick_column(name: str) -> Column:
    path = f"body.Header.{name}" if name in HEADER else f"body.{name}"
    if name in TICK_VALUES or name in TICK_COUNTS:
        path += ".value"
    column = as_utc(F.col(path)) if name in INSTANTS else F.col(path)
    return column.alias(name)


def flatten_ticks(messages: DataFrame) -> DataFrame:
    """Nested ``body`` as flat columns; instants become UTC time without zone."""
    return messages.select(*(_tick_column(name) for name in TICK_COLUMNS))


def read_ticks(records: DataFrame, descriptor: str | None = None, wanted: str = TICK_CLASS) -> DataFrame:
    """Flat ticks of protobuf messages if a descriptor file is given, of JSON messages otherwise."""
    return parse_tick_bytes(records, descriptor, wanted) if descriptor else parse_ticks(records, wanted)


def start_tick_table(
    spark: SparkSession, source: StreamSource, path: str, checkpoint: str, descriptor: str | None = None,
    zone: str = MARKET_ZONE,
) -> StreamingQuery:
    """Append flat ticks to the tick table, stored by local day."""
    flat = read_ticks(source.open(spark), descriptor)
    stored = flat.withColumn("partition_date", F.to_date(to_local(F.col("Last_updated"), zone)))
    return (
        stored.writeStream.format("parquet").outputMode("append").partitionBy("partition_date")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )


def turnover_stream(ticks: DataFrame, delay: str, zone: str = MARKET_ZONE) -> DataFrame:
    """Daily turnover of a tick stream, for append mode: a local day appears once the watermark has passed its end.

    State holds one tick per index and open day. Ticks later than ``delay`` are left out and show as
    ``late_ticks``; ``refresh.refresh_turnover`` recomputes their days from the tick table.
    """
    # Event time has to be an instant; this one reads as local time in UTC, so that days begin at local midnight.
    shifted = F.from_utc_timestamp(as_instant(F.col("Last_updated")), zone)
    local = ticks.select("IndexCode", shifted.alias("trading_time"), "TotalValuesTraded").withWatermark(
        "trading_time", delay
    )
    newest = F.max(F.struct("trading_time", "TotalValuesTraded"))
    last = local.groupBy(F.window("trading_time", "1 day").alias("day"), "IndexCode").agg(newest.alias("newest"))
    return last.groupBy("day").agg(F.sum("newest.TotalValuesTraded").alias("total_market_value")).select(
        F.to_date(as_utc(F.col("day.start"))).alias("C_DATE"), "total_market_value"
    )


def start_turnover(
    spark: SparkSession, source: StreamSource, path: str, checkpoint: str, delay: str, descriptor: str | None = None,
    zone: str = MARKET_ZONE,
) -> StreamingQuery:
    """Append the turnover of closed days."""
    turnover = turnover_stream(read_ticks(source.open(spark), descriptor), delay, zone)
    return (
        turnover.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )


def late_ticks(query: StreamingQuery) -> int:
    """Rows that the recent batches of a turnover query dropped as too late."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress for operator in progress["stateOperators"]
    )
