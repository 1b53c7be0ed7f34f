"""Derived tables kept by the changes of a state alone: account sums of the day's deals, and the account dimension.

The state of a feed is a keyed table. A step reads the difference between the version that a derived table has seen and
the current one, and adds a delta to the derived table, whose commit carries the version seen. A step that is repeated, or
a batch that was fed twice, finds no difference; changes that lose by time make none.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType

from ledgerlake.functions import measures
from ledgerlake.operators.keyed import KeyedTable, LostRace, bucket
from ledgerlake.plans import gold
from ledgerlake.specs import ACCOUNT_FEED, DEAL_FEED, DELETE, VERSION_ORDER, FeedSpec

STATE = "state"  # name of the source in the commits of the derived tables
ATTEMPTS = 3
DIM_INPUTS = ("C_ACCOUNT_CODE", "C_ACCOUNT_BRANCH_CODE", "C_CHANNEL", "C_OPEN_DATE")


def day_state_table(path: str, feed: FeedSpec = DEAL_FEED) -> KeyedTable:
    """Newest version of each row on each local day, stored by day; deletes are kept as tombstones."""
    columns = [field for field in feed.row.fields if field.name in ("C_ACCOUNT_CODE", "C_MATCHED_PRICE", "C_MATCHED_VOLUME")]
    schema = StructType([
        StructField(feed.key, StringType()), StructField("partition_date", DateType()), *columns,
        StructField("ts_ms", LongType()), StructField("scn", DecimalType(38, 0)), StructField("ts_ns", LongType()),
        StructField("deleted", BooleanType()),
    ])
    return KeyedTable(path, schema, (feed.key, "partition_date"), VERSION_ORDER, "partition_date", deleted="deleted")


def add_day_changes(log: DataFrame, state: KeyedTable, source: str | None = None, batch: int | None = None) -> None:
    """Add rows of the change log to the day state, at their own cost."""
    state.append_delta(log.withColumn("deleted", F.col("op") == DELETE), source, batch)


def account_sums_table(path: str) -> KeyedTable:
    """Traded value and number of current deals per account and local day."""
    schema = StructType([
        StructField("C_ACCOUNT_CODE", StringType()), StructField("partition_date", DateType()),
        StructField("C_GTGD", measures.PRODUCT), StructField("deals", LongType()),
        StructField("state_version", LongType()), StructField("empty", BooleanType()),
    ])
    return KeyedTable(path, schema, ("C_ACCOUNT_CODE", "partition_date"), ("state_version",), "partition_date", deleted="empty")


def signed_deals(changes: DataFrame) -> DataFrame:
    """Every change as a pair: the row before with sign -1, the row after with sign 1."""
    sides = F.array(F.struct(F.col("before").alias("row"), F.lit(-1).alias("sign")), F.struct(F.col("after").alias("row"), F.lit(1).alias("sign")))
    pairs = changes.select("partition_date", F.explode(sides).alias("side")).where("side.row IS NOT NULL")
    return pairs.select("partition_date", "side.row.*", "side.sign")


def update_account_sums(spark: SparkSession, state: KeyedTable, sums: KeyedTable) -> int | None:
    """Add what has changed in the day state to the sums and return the version of the state they hold. Only days that have
    changed are read, and accounts without changes are not written. Deals without account belong to no sum."""
    for _ in range(ATTEMPTS):
        seen, now = sums.commit(spark), state.last_version(spark)
        if now is None or seen.batches.get(STATE) == now:
            return now
        signed = signed_deals(state.changes_between(spark, seen.batches.get(STATE), now))
        value = F.coalesce(measures.traded_value(signed).cast(measures.PRODUCT), F.lit(0))
        added = signed.groupBy("C_ACCOUNT_CODE", "partition_date").agg(
            F.sum(F.col("sign") * value).alias("more"), F.sum("sign").alias("more_deals"))
        days = set(_changed_parts(spark, state, seen.batches.get(STATE), now))
        old = sums.read(spark, days, seen.version) if seen.version is not None else spark.createDataFrame([], sums.schema)
        total = added.join(old, ["C_ACCOUNT_CODE", "partition_date"], "left").select(
            "C_ACCOUNT_CODE", "partition_date",
            (F.coalesce("C_GTGD", F.lit(0)) + F.col("more")).cast(measures.PRODUCT).alias("C_GTGD"),
            (F.coalesce("deals", F.lit(0)) + F.col("more_deals")).alias("deals"),
        ).withColumns({"state_version": F.lit(now).cast("long"), "empty": F.col("deals") == 0})
        try:
            sums.append_delta(total, STATE, now, onto=seen)
            return now
        except LostRace:  # another run was faster; what is left is computed from its sums
            continue
    raise LostRace(sums.path)


def _changed_parts(spark: SparkSession, table: KeyedTable, old: int | None, new: int) -> list[str]:
    was = {} if old is None else table.commit(spark, old).parts
    now = table.commit(spark, new).parts
    return [part for part in {*was, *now} if was.get(part) != now.get(part)]


def front_data(spark: SparkSession, sums: KeyedTable, as_of: dt.date) -> DataFrame:
    """``gold.front_data`` of the local day from the stored sums."""
    return gold.front_data_of_sums(sums.read(spark, {as_of.isoformat()}).select("C_ACCOUNT_CODE", "C_GTGD"), as_of)


# --- account dimension ---


def account_dim_table(path: str) -> KeyedTable:
    """``back_account_dim`` by account code; codes that have no account any more are kept as tombstones."""
    schema = StructType([
        StructField("C_ORIGIN_ACCOUNT_CODE", StringType()), StructField("C_ACCOUNT_CODE", StringType()),
        ACCOUNT_FEED.row["C_OPEN_DATE"], StructField("C_BRANCH_NAME", StringType()), StructField("C_CHANNEL_NAME", StringType()),
        StructField("state_version", LongType()), StructField("gone", BooleanType()), StructField("bucket", IntegerType()),
    ])
    return KeyedTable(path, schema, ("C_ACCOUNT_CODE",), ("state_version",), "bucket", deleted="gone")


def touched_codes(changes: DataFrame) -> DataFrame:
    """Account codes that changed accounts had before or have now."""
    codes = changes.select(F.explode(F.array("before.C_ACCOUNT_CODE", "after.C_ACCOUNT_CODE")).alias("C_ACCOUNT_CODE"))
    return codes.where("C_ACCOUNT_CODE IS NOT NULL").distinct()


def update_account_dim(spark: SparkSession, state: KeyedTable, dim: KeyedTable, buckets: int) -> int | None:
    """Recompute the account codes that have changed since the last run and upsert them; the version of the state that the
    dimension holds. A code that lost its account goes, one that several accounts have had keeps the one changed last.
    The state is read in few columns and joined with the touched codes; only these are written."""
    for _ in range(ATTEMPTS):
        seen, now = dim.commit(spark), state.last_version(spark)
        if now is None or seen.batches.get(STATE) == now:
            return now
        codes = touched_codes(state.changes_between(spark, seen.batches.get(STATE), now))
        accounts = state.read(spark, version=now, columns=DIM_INPUTS).join(codes, "C_ACCOUNT_CODE", "left_semi")
        rows = codes.join(gold.back_account_dim(accounts).withColumn("found", F.lit(True)), "C_ACCOUNT_CODE", "left").withColumns({
            "state_version": F.lit(now).cast("long"), "gone": F.col("found").isNull(), "bucket": bucket(["C_ACCOUNT_CODE"], buckets)})
        try:
            dim.append_delta(rows, STATE, now, onto=seen)
            return now
        except LostRace:
            continue
    raise LostRace(dim.path)


def account_dim(spark: SparkSession, dim: KeyedTable) -> DataFrame:
    return dim.read(spark).drop("state_version", "gone", "bucket")
