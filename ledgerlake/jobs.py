"""Jobs over one lake, for ``spark-submit``::

    spark-submit --py-files ledgerlake.zip ledgerlake/jobs.py CONFIG.json JOB [--as-of 2024-01-11] [...]

The JSON file names the folders ``silver``, ``warehouse``, ``gold`` and ``checkpoints``, the ``jdbc`` options (``url``,
``user``, ``password``, ``driver``), the read predicates per table (``split``), and per feed the ``kafka`` settings of
``KafkaStream``; ``descriptor`` is the protobuf descriptor file of binary ticks, ``database`` the catalog database in which
loaded silver tables are registered, if they are. No job reads the clock for its data: the
day comes from ``--as-of``; load times are recorded only.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import session, specs
from ledgerlake.functions.times import previous_month
from ledgerlake.operators import reports, tables
from ledgerlake.operators.dayindex import DayIndex
from ledgerlake.operators.keyed import KeyedTable
from ledgerlake.operators.latest import current_state
from ledgerlake.plans import gold, silver
from ledgerlake.sources import warehouse
from ledgerlake.sources.relational import JdbcSource, Source, extract_columns, extract_previous_month, hash_split
from ledgerlake.sources.streams import KafkaStream, StreamSource
from ledgerlake.streaming import cdc, refresh, sums, ticks
from ledgerlake.streaming.compaction import CompactedLog

FEEDS = {feed.name: feed for feed in (specs.ACCOUNT_FEED, specs.DEAL_FEED)}
FACTS = (specs.MARGIN_BALANCE, specs.DEBIT_BALANCE, specs.ADVANCE_WITHDRAW, specs.DEAL_HISTORY)
READS = 8  # connections that read one table, unless the configuration splits it otherwise
OPEN_DATES = "MISUSER.V_T_BACK_ACCOUNT"  # fixed value: the open-date view


@dataclass(frozen=True)
class Lake:
    """Where the tables are and where they come from."""

    silver: str
    warehouse: str
    gold: str
    checkpoints: str
    source: Source | None = None
    streams: dict[str, StreamSource] = field(default_factory=dict)
    buckets: int = 64
    delay: str = "10 minutes"
    descriptor: str | None = None
    database: str | None = None

    def fact(self, spec: specs.TableSpec) -> KeyedTable:
        return silver.warehouse_table(spec, f"{self.warehouse}/{spec.name}")

    def index(self, spec: specs.TableSpec) -> DayIndex | None:
        """Withdraw days of advances, which are stored by the day of approval."""
        return DayIndex(f"{self.warehouse}/{spec.name}_days", "C_WITHDRAW_DATE") if spec is specs.ADVANCE_WITHDRAW else None

    def day_state(self) -> KeyedTable:
        return sums.day_state_table(f"{self.warehouse}/t_front_deal_days")

    def account_sums(self) -> KeyedTable:
        return sums.account_sums_table(f"{self.gold}/front_data_sums")

    def account_dim(self) -> KeyedTable:
        return sums.account_dim_table(f"{self.gold}/dim_back_account_keyed")

    def compacted_log(self, feed: specs.FeedSpec) -> CompactedLog:
        return CompactedLog(self.log(feed), f"{self.silver}/{feed.name}_log_compacted")

    def state(self, feed: specs.FeedSpec) -> KeyedTable:
        return cdc.state_table(f"{self.warehouse}/{feed.name}", feed)

    def log(self, feed: specs.FeedSpec) -> str:
        return f"{self.silver}/{feed.name}_log"

    def ticks(self) -> str:
        return f"{self.silver}/market_data_index"

    def facts(self, spark: SparkSession, days: list[dt.date] | None = None) -> tuple[DataFrame, ...]:
        """The facts in the argument order of ``gold.back_data``. Given days, only partitions that may hold rows of these days are
        read; those of advances, which are stored by approval day, come from their index."""
        def parts(spec: specs.TableSpec) -> set[str] | None:
            if not days:
                return None
            index = self.index(spec)
            if index is None:
                return {day.isoformat() for day in days}
            found = [index.parts(spark, first, end) for first, end in _runs(days)]
            return None if None in found else set().union(*found)

        return tuple(self.fact(spec).read(spark, parts(spec)) for spec in FACTS)


def _runs(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """The days as ranges without gaps."""
    out: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        if out and out[-1][1] == day:
            out[-1] = (out[-1][0], day + dt.timedelta(days=1))
        else:
            out.append((day, day + dt.timedelta(days=1)))
    return out


def load_silver(
    spark: SparkSession, lake: Lake, spec: specs.TableSpec, loaded_at: dt.datetime,
    first: dt.date | None = None, end: dt.date | None = None,
) -> None:
    """Source to silver: the whole table, or the days in ``[first, end)``."""
    if first is not None and spec.date_column is None:
        raise ValueError(f"{spec.name} has no business date to load days by")
    path = f"{lake.silver}/{spec.name}"
    rows = silver.source_to_silver(spark, lake.source, spec, path, loaded_at, first, end)
    reports.record_load(spark, f"{lake.silver}/loads", spec.name, rows, loaded_at)
    if lake.database:
        tables.register_external(spark, f"{lake.database}.{spec.name}", path)


def publish_silver(spark: SparkSession, lake: Lake, spec: specs.TableSpec) -> None:
    """Silver to the warehouse, an upsert by primary key."""
    published = silver.publish_table(warehouse.scan(spark, f"{lake.silver}/{spec.name}"), spec)
    if index := lake.index(spec):
        index.add(published)
    lake.fact(spec).upsert(published)


def load_increment(
    spark: SparkSession, lake: Lake, spec: specs.TableSpec, as_of: dt.date, loaded_at: dt.datetime
) -> None:
    """The day (or month) before ``as_of`` from the source into the warehouse table."""
    if spec not in (*specs.DAILY_FACTS, specs.RANKING_DETAIL):
        raise ValueError(f"{spec.name} is not loaded by days or months")
    silver.incremental_load(spark, lake.source, spec, lake.fact(spec), as_of, loaded_at, lake.index(spec))


def build_back_data(spark: SparkSession, lake: Lake, first: dt.date, end: dt.date) -> None:
    """Account-day rows of ``[first, end)``, replacing those days."""
    days = [first + dt.timedelta(days=i) for i in range((end - first).days)]
    gold.write_account_days(gold.back_data_days(*lake.facts(spark, days), first, end), f"{lake.gold}/back_data")


def refresh_products(spark: SparkSession, lake: Lake, as_of: dt.date | None = None) -> None:
    """Bring every derived table up to date with its sources, at the cost of what has changed in them: account-days, rankings,
    the account dimension and, given ``as_of``, the values of that day. Market turnover follows its ticks (``turnover-live``)."""
    facts = {name: lake.fact(spec) for name, spec in zip(refresh.BUSINESS_DATES, FACTS, strict=True)}
    products = (
        refresh.account_days_product(facts, f"{lake.gold}/back_data", read=lake.facts),
        refresh.ranking_product(lake.fact(specs.RANKING_DETAIL), f"{lake.gold}/dim_erc_ranking"),
    )
    for product in products:
        refresh.refresh_product(spark, product, f"{lake.gold}/seen/{product.name}")
    sums.update_account_dim(spark, lake.state(specs.ACCOUNT_FEED), lake.account_dim(), lake.buckets)
    if as_of is not None:
        sums.update_account_sums(spark, lake.day_state(), lake.account_sums())
        tables.overwrite(sums.front_data(spark, lake.account_sums(), as_of), f"{lake.gold}/front_data")


def build_back_data_rejects(spark: SparkSession, lake: Lake) -> None:
    """Rows of the facts that belong to no account-day, and deals whose value is rounded."""
    tables.overwrite(gold.back_data_rejects(*lake.facts(spark)), f"{lake.gold}/back_data_rejects")


def build_front_data(spark: SparkSession, lake: Lake, as_of: dt.date) -> None:
    """Today's values, replacing yesterday's."""
    log = warehouse.scan(spark, lake.log(specs.DEAL_FEED))
    tables.overwrite(gold.front_data(log, as_of), f"{lake.gold}/front_data")


def build_ranking(spark: SparkSession, lake: Lake, as_of: dt.date | None = None) -> None:
    """All rankings, or those of the month before ``as_of``; a month is replaced as a whole."""
    months = None if as_of is None else {"/".join(map(str, previous_month(as_of)))}
    detail = lake.fact(specs.RANKING_DETAIL).read(spark, months)
    if as_of is not None:
        detail = extract_previous_month(detail, as_of)
    tables.overwrite_partitions(
        gold.erc_ranking(detail), f"{lake.gold}/dim_erc_ranking", ["C_YEAR_ADJ", "C_MONTH_ADJ"]
    )


def build_account_dim(spark: SparkSession, lake: Lake) -> None:
    accounts = lake.state(specs.ACCOUNT_FEED).read(spark)
    tables.overwrite(gold.back_account_dim(accounts), f"{lake.gold}/dim_back_account")


def build_open_dates(spark: SparkSession, lake: Lake) -> None:
    """Open dates from the source view, and the current accounts with them."""
    path = f"{lake.warehouse}/dim_v_t_back_account"
    tables.overwrite(extract_columns(spark, lake.source, OPEN_DATES, ["C_ACCOUNT_CODE", "C_OPEN_DATE"]), path)
    joined = gold.account_open_dates(lake.state(specs.ACCOUNT_FEED).read(spark), warehouse.scan(spark, path))
    tables.overwrite(joined, f"{lake.gold}/mv_t_back_account")


def build_turnover(spark: SparkSession, lake: Lake, first: dt.date, end: dt.date) -> None:
    refresh.refresh_turnover(warehouse.scan(spark, lake.ticks()), f"{lake.gold}/market_data", first, end)


def run_change_log(spark: SparkSession, lake: Lake, feed: specs.FeedSpec) -> None:
    checkpoint, source = f"{lake.checkpoints}/{feed.name}_log", lake.streams[feed.name]
    cdc.start_change_log(spark, source, feed, lake.log(feed), checkpoint).awaitTermination()


def run_state(spark: SparkSession, lake: Lake, feed: specs.FeedSpec) -> None:
    checkpoint, source = f"{lake.checkpoints}/{feed.name}_state", lake.streams[feed.name]
    if isinstance(source, KafkaStream):
        source = replace(source, starting="earliest")  # a state needs all changes, whenever it is begun
    cdc.start_apply_changes(spark, source, feed, lake.state(feed), checkpoint, lake.buckets).awaitTermination()


def run_day_state(spark: SparkSession, lake: Lake) -> None:
    """Newest version of each deal and local day, from the deal feed."""
    feed, source, table = specs.DEAL_FEED, lake.streams[specs.DEAL_FEED.name], lake.day_state()
    if isinstance(source, KafkaStream):
        source = replace(source, starting="earliest")

    def add(batch: DataFrame, batch_id: int) -> None:
        sums.add_day_changes(cdc.change_log(batch, feed), table, cdc.batch_source(batch), batch_id)

    cdc.valid_changes(source.open(spark), feed).writeStream.foreachBatch(add).option(
        "checkpointLocation", f"{lake.checkpoints}/{feed.name}_days").trigger(availableNow=True).start().awaitTermination()


def keyed_tables(lake: Lake) -> list[KeyedTable]:
    facts = [lake.fact(spec) for spec in specs.TABLES.values()]
    return [*facts, *(lake.state(feed) for feed in FEEDS.values()), lake.day_state(), lake.account_sums(), lake.account_dim()]


def fold_tables(spark: SparkSession, lake: Lake, least: int = 8) -> None:
    """Merge the deltas of partitions that have gathered ``least`` of them, in all keyed tables."""
    for table in keyed_tables(lake):
        table.fold(spark, least)


def expire_tables(spark: SparkSession, lake: Lake, keep: int = 20) -> None:
    """Remove old versions of all keyed tables. A product that was not refreshed for that many versions is rebuilt by hand."""
    for table in keyed_tables(lake):
        table.expire(spark, keep)


def compact_log(spark: SparkSession, lake: Lake, feed: specs.FeedSpec, before: dt.date) -> None:
    lake.compacted_log(feed).compact(spark, before)


def run_rejects(spark: SparkSession, lake: Lake, feed: specs.FeedSpec) -> None:
    checkpoint, source = f"{lake.checkpoints}/{feed.name}_rejects", lake.streams[feed.name]
    cdc.start_rejects(spark, source, feed, f"{lake.silver}/{feed.name}_rejects", checkpoint).awaitTermination()


def run_ticks(spark: SparkSession, lake: Lake) -> None:
    ticks.start_tick_table(
        spark, lake.streams["ticks"], lake.ticks(), f"{lake.checkpoints}/ticks", lake.descriptor
    ).awaitTermination()


def run_turnover(spark: SparkSession, lake: Lake) -> None:
    path, checkpoint = f"{lake.gold}/market_data_closed", f"{lake.checkpoints}/turnover"
    ticks.start_turnover(
        spark, lake.streams["ticks"], path, checkpoint, lake.delay, lake.descriptor
    ).awaitTermination()


def run_live_turnover(spark: SparkSession, lake: Lake) -> None:
    """Turnover of all days that the tick table has news of, the running one included."""
    refresh.start_turnover_refresh(
        spark, lake.ticks(), f"{lake.gold}/market_data", f"{lake.checkpoints}/market_data").awaitTermination()


def deals_of_change_log(spark: SparkSession, lake: Lake) -> DataFrame:
    """Current deals according to the change log, for checks against the keyed state."""
    log = lake.compacted_log(specs.DEAL_FEED).read(spark)
    return current_state(log, [specs.DEAL_FEED.key], specs.VERSION_ORDER, F.col("op") == specs.DELETE)


def lake_of(config: dict) -> Lake:
    jdbc = config.get("jdbc")
    split = {spec.source: hash_split(spec.key, READS) for spec in specs.TABLES.values()} | config.get("split", {})
    return Lake(
        **{name: config[name].rstrip("/") for name in ("silver", "warehouse", "gold", "checkpoints")},
        source=JdbcSource(jdbc, split) if jdbc else None,
        streams={name: KafkaStream(**options) for name, options in config.get("kafka", {}).items()},
        **{name: config[name] for name in ("buckets", "delay", "descriptor", "database") if name in config},
    )


def jobs(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> dict[str, Callable[[], None]]:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    spec, feed = specs.TABLES.get(args.table), FEEDS.get(args.feed)
    return {
        "silver": lambda: load_silver(spark, lake, spec, now, args.first, args.end),
        "publish": lambda: publish_silver(spark, lake, spec),
        "increment": lambda: load_increment(spark, lake, spec, args.as_of, now),
        "back-data": lambda: build_back_data(spark, lake, args.first, args.end),
        "back-data-rejects": lambda: build_back_data_rejects(spark, lake),
        "refresh": lambda: refresh_products(spark, lake, args.as_of),
        "front-data": lambda: build_front_data(spark, lake, args.as_of),
        "truncate-front-data": lambda: tables.truncate(spark, f"{lake.gold}/front_data"),
        "ranking": lambda: build_ranking(spark, lake, args.as_of),
        "account-dim": lambda: build_account_dim(spark, lake),
        "open-dates": lambda: build_open_dates(spark, lake),
        "turnover": lambda: build_turnover(spark, lake, args.first, args.end),
        "change-log": lambda: run_change_log(spark, lake, feed),
        "state": lambda: run_state(spark, lake, feed),
        "day-state": lambda: run_day_state(spark, lake),
        "fold": lambda: fold_tables(spark, lake),
        "expire": lambda: expire_tables(spark, lake),
        "compact-log": lambda: compact_log(spark, lake, feed, args.as_of),
        "rejects": lambda: run_rejects(spark, lake, feed),
        "ticks": lambda: run_ticks(spark, lake),
        "turnover-live": lambda: run_live_turnover(spark, lake),
        "turnover-stream": lambda: run_turnover(spark, lake),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerlake.jobs")
    parser.add_argument("config")
    parser.add_argument("job")
    parser.add_argument("--table", choices=sorted(specs.TABLES))
    parser.add_argument("--feed", choices=sorted(FEEDS))
    for option in ("--as-of", "--first", "--end"):
        parser.add_argument(option, type=dt.date.fromisoformat)
    args = parser.parse_args(argv)
    with open(args.config, encoding="utf-8") as file:
        lake = lake_of(json.load(file))
    known = jobs(session.build(f"ledgerlake-{args.job}"), lake, args)
    if args.job not in known:
        parser.error(f"unknown job {args.job}; known: {', '.join(known)}")
    known[args.job]()


if __name__ == "__main__":
    main()
