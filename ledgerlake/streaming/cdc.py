"""Change feeds: parsing, the append-only change log and the keyed current state.

Functions on records work on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerlake.functions.times import MARKET_ZONE, local_from_millis
from ledgerlake.operators.keyed import KeyedTable, bucket
from ledgerlake.operators.projections import computed_once
from ledgerlake.schemas import BROKEN, change_envelope, struct
from ledgerlake.sources.streams import StreamSource
from ledgerlake.specs import DELETE, UPSERTS, VERSION_ORDER, FeedSpec


def _key(feed: FeedSpec, value: Column) -> Column:
    """Key as text; a numeric key goes through a whole decimal, since a double prints with an exponent."""
    if isinstance(feed.row[feed.key].dataType, DoubleType):
        value = value.try_cast("decimal(38,0)")
    return value.cast("string")


def parse_changes(lines: DataFrame, feed: FeedSpec) -> DataFrame:
    """Change records of ``value``: key, op, order, creation time and the columns of the row after the change.

    Those are NULL for a delete, whose key comes from the row before. Text that is not a change record gives a row
    without key; ``broken`` marks records with a field that is not of its type; ``value`` stays for the reject output.
    """
    row = feed.row
    parsed = computed_once(F.from_json("value", change_envelope(row), {"columnNameOfCorruptRecord": BROKEN}))
    record = lines.select("value", parsed.alias("record")).select("value", "record.payload.*", f"record.{BROKEN}")
    given = F.coalesce(f"after.{feed.created_column}", f"before.{feed.created_column}") if feed.created_column else F.lit(None)
    created = given.try_cast("timestamp_ntz")
    return record.select(
        "value",
        _key(feed, F.coalesce(f"after.{feed.key}", f"before.{feed.key}")).alias(feed.key),
        "op",
        "ts_ms",
        F.col("source.scn").try_cast("decimal(38,0)").alias("scn"),
        "ts_ns",
        created.alias("created"),
        (F.col(BROKEN).isNotNull() | (given.isNotNull() & created.isNull())).alias("broken"),
        *(F.col(f"after.{name}").alias(name) for name in row.names if name != feed.key),
    )


def parse_rows(lines: DataFrame, feed: FeedSpec) -> DataFrame:
    """Plain JSON rows without envelope; broken text gives a row without key."""
    row = feed.row
    parsed = computed_once(F.from_json("value", row))
    record = lines.select("value", parsed.alias("record")).select("value", "record.*")
    return record.withColumn(feed.key, _key(feed, F.col(feed.key)))


def is_valid(feed: FeedSpec) -> Column:
    known = F.col("op").isin(*UPSERTS, DELETE)
    return F.coalesce(F.col(feed.key).isNotNull() & F.col("ts_ms").isNotNull() & known & ~F.col("broken"), F.lit(False))


def rejects(lines: DataFrame, feed: FeedSpec) -> DataFrame:
    """Raw text of records without key or time, with an unknown operation, or with a field that is not of its type."""
    return parse_changes(lines, feed).where(~is_valid(feed)).select("value")


def valid_changes(lines: DataFrame, feed: FeedSpec) -> DataFrame:
    return parse_changes(lines, feed).where(is_valid(feed)).drop("value", "broken")


def op_flag() -> Column:
    """0 for an upsert, 1 for a delete."""
    return F.when(F.col("op") == DELETE, 1).otherwise(0)


def change_log(changes: DataFrame, feed: FeedSpec, zone: str = MARKET_ZONE) -> DataFrame:
    """Change-log rows: creation and update in local time, the local update day, and the exact order columns.

    A create record is created when it is updated; other records keep the row's own creation time, if it has one.
    """
    updated = local_from_millis(F.col("ts_ms"), zone)
    business = [name for name in feed.row.names if name not in (feed.key, feed.created_column)]
    return changes.select(
        feed.key,
        F.when(F.col("op") == "c", updated).otherwise(F.col("created")).alias("created_at"),
        updated.alias("updated_at"),
        "op",
        *business,
        F.to_date(updated).alias("partition_date"),
        *VERSION_ORDER,
    )


def state_schema(feed: FeedSpec) -> StructType:
    return StructType([
        StructField(feed.key, StringType()),
        *(field for field in feed.row.fields if field.name != feed.key),
        *struct("__op int, ts_ms bigint, scn decimal(38,0), ts_ns bigint, deleted boolean, bucket int").fields,
    ])


def state_rows(changes: DataFrame, feed: FeedSpec, buckets: int) -> DataFrame:
    """Rows for the keyed state, in its column order, with the operation flag."""
    return changes.select(
        feed.key,
        *(name for name in feed.row.names if name != feed.key),
        op_flag().alias("__op"),
        *VERSION_ORDER,
        (F.col("op") == DELETE).alias("deleted"),
        bucket([feed.key], buckets).alias("bucket"),
    )


def state_table(path: str, feed: FeedSpec) -> KeyedTable:
    """Current rows of a feed, one per key. Changes that arrive late lose by time, also against a delete."""
    return KeyedTable(path, state_schema(feed), (feed.key,), VERSION_ORDER, "bucket", deleted="deleted")


def start_change_log(
    spark: SparkSession, source: StreamSource, feed: FeedSpec, path: str, checkpoint: str, zone: str = MARKET_ZONE
) -> StreamingQuery:
    """Append everything that waits in the source to the change log, then stop; a later start goes on from there."""
    log = change_log(valid_changes(source.open(spark), feed), feed, zone)
    return (
        log.writeStream.format("parquet").outputMode("append").partitionBy("partition_date")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )


def start_rejects(
    spark: SparkSession, source: StreamSource, feed: FeedSpec, path: str, checkpoint: str
) -> StreamingQuery:
    """Append the raw text of rejected records."""
    return (
        rejects(source.open(spark), feed).writeStream.format("text").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )


def check_buckets(spark: SparkSession, table: KeyedTable, buckets: int) -> None:
    """Keep the number of buckets with the table, since another number would put keys into other buckets."""
    path = f"{table.path}/buckets"
    try:
        stored = int(spark.read.text(path).first().value)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.createDataFrame([(str(buckets),)], "value string").coalesce(1).write.text(path)
        return
    if stored != buckets:
        raise ValueError(f"{table.path} has {stored} buckets, not {buckets}")


def apply_changes(
    changes: DataFrame, feed: FeedSpec, table: KeyedTable, buckets: int, source: str | None = None, batch: int | None = None
) -> None:
    """Add a batch of changes to the keyed state, at the cost of the batch. Applying a batch again changes nothing."""
    check_buckets(changes.sparkSession, table, buckets)
    table.append_delta(state_rows(changes, feed, buckets), source, batch)


def batch_source(batch: DataFrame) -> str:
    """Identity of the streaming query that a micro-batch belongs to; a new checkpoint makes a new query."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def start_apply_changes(
    spark: SparkSession, source: StreamSource, feed: FeedSpec, table: KeyedTable, checkpoint: str, buckets: int
) -> StreamingQuery:
    """Bring the keyed state up to date with everything that waits in the source, then stop.

    Every micro-batch becomes a delta of the state, and its number is stored with it, so one that comes again after a crash is
    skipped. ``table.fold`` merges the deltas from time to time.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        apply_changes(batch, feed, table, buckets, batch_source(batch), batch_id)

    return (
        valid_changes(source.open(spark), feed).writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
