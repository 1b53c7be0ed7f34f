"""Gold products: account-day measures, today's values, ranking, account dimension and market turnover."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions import labels, measures
from ledgerlake.functions.times import MARKET_ZONE, between_days, period_start, to_local
from ledgerlake.operators import tables
from ledgerlake.operators.latest import current_state, latest_version
from ledgerlake.operators.projections import publish, split_null_keys
from ledgerlake.specs import DELETE, VERSION_ORDER

MEASURES = ("C_MARGIN_DEBT", "C_MBLINK_DEBT", "C_UTTB", "C_GTGD")
ACCOUNT_DAY = ["C_ACCOUNT_CODE", "C_DATE"]
# Business dates whose day is the partition of their table; advances are stored by approval day instead.
PARTITION_DATES = ("C_TRADING_DATE", "C_TRANSACTION_DATE")


def _measure_rows(df: DataFrame, date_column: str, name: str, value: Column) -> DataFrame:
    return df.select("C_ACCOUNT_CODE", F.col(date_column).alias("C_DATE"), value.alias(name))


def margin_rows(margin: DataFrame) -> DataFrame:
    return _measure_rows(margin, "C_TRADING_DATE", "C_MARGIN_DEBT", measures.margin_debt())


def debit_rows(debit: DataFrame) -> DataFrame:
    return _measure_rows(debit, "C_TRANSACTION_DATE", "C_MBLINK_DEBT", measures.mblink_debt())


def advance_rows(advances: DataFrame) -> DataFrame:
    return _measure_rows(advances, "C_WITHDRAW_DATE", "C_UTTB", measures.cash_advance())


def deal_rows(deals: DataFrame) -> DataFrame:
    return _measure_rows(deals, "C_TRANSACTION_DATE", "C_GTGD", measures.traded_value(deals))


def measure_by_account_day(rows: DataFrame) -> DataFrame:
    """Sum of the one measure in ``rows`` per account and day, with the calendar columns."""
    name = rows.columns[-1]
    return rows.groupBy(*ACCOUNT_DAY).agg(F.sum(name).alias(name)).select(
        *ACCOUNT_DAY, F.month("C_DATE").alias("C_MONTH"), F.year("C_DATE").alias("C_YEAR"), name
    )


def margin_debt(margin: DataFrame) -> DataFrame:
    return measure_by_account_day(margin_rows(margin))


def mblink_debt(debit: DataFrame) -> DataFrame:
    return measure_by_account_day(debit_rows(debit))


def advance_withdraw(advances: DataFrame) -> DataFrame:
    return measure_by_account_day(advance_rows(advances))


def traded_value(deals: DataFrame) -> DataFrame:
    return measure_by_account_day(deal_rows(deals))


def _with_labels(df: DataFrame, *others: str) -> DataFrame:
    """Account-day rows with missing measures as 0 and the calendar, ranking and period columns, and ``others`` as they are."""
    origin, year, month = labels.origin_account(F.col("C_ACCOUNT_CODE")), F.year("C_DATE"), F.month("C_DATE")
    return df.select(
        origin.alias("C_ORIGIN_ACCOUNT_CODE"),
        *ACCOUNT_DAY,
        month.alias("C_MONTH"),
        year.alias("C_YEAR"),
        *(F.coalesce(name, F.lit(0)).alias(name) for name in MEASURES),
        labels.ranking_key(origin, year, month).alias("C_RANKING_KEY"),
        labels.kpi_period(year, month).alias("C_KY_KPI"),
        *others,
    )


def back_data_of(rows: DataFrame) -> DataFrame:
    """Account-day table of measure rows: account, date and any of the four measures.

    One aggregation over all measures. Partial sums run before the single shuffle, so an account or a day that holds
    a large part of the rows arrives as one row per task. Rows without account or date belong to no account-day;
    ``back_data_rejects`` lists them.
    """
    present = [name for name in MEASURES if name in rows.columns]
    absent = [F.lit(0).alias(name) for name in MEASURES if name not in rows.columns]
    keyed, _ = split_null_keys(rows, ACCOUNT_DAY)
    sums = keyed.groupBy(*ACCOUNT_DAY).agg(*(F.sum(name).alias(name) for name in present))
    return _with_labels(sums.select("*", *absent))


def back_data(margin: DataFrame, debit: DataFrame, advances: DataFrame, deals: DataFrame) -> DataFrame:
    """Margin debt, linked-bank debt, advanced cash and traded value per account and day."""
    parts = [margin_rows(margin), debit_rows(debit), advance_rows(advances), deal_rows(deals)]
    return back_data_of(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))


def back_data_rejects(margin: DataFrame, debit: DataFrame, advances: DataFrame, deals: DataFrame) -> DataFrame:
    """Rows that ``back_data`` cannot place, and deals whose value it rounds, with the reason. The latter are in its
    sums all the same."""
    parts = {
        "margin": margin_rows(margin), "debit": debit_rows(debit),
        "advance": advance_rows(advances), "deal": deal_rows(deals),
    }
    rejected = [
        split_null_keys(rows, ACCOUNT_DAY)[1].select(
            F.lit(name).alias("measure"), *ACCOUNT_DAY, F.lit("no account or date").alias("reason")
        )
        for name, rows in parts.items()
    ]
    rejected.append(measures.rounded_deals(deals).select(
        F.lit("deal").alias("measure"), "C_ACCOUNT_CODE", F.col("C_TRANSACTION_DATE").alias("C_DATE"),
        F.lit("value is rounded").alias("reason"),
    ))
    return reduce(DataFrame.unionByName, rejected)


def full_outer(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join of two account-day tables; the key of either side remains."""
    return left.join(right, ACCOUNT_DAY, "full_outer")


def back_data_joined(margin: DataFrame, debit: DataFrame, advances: DataFrame, deals: DataFrame) -> DataFrame:
    """``back_data`` as a chain of full outer joins of the four aggregates: the literal form, kept for comparison.
    It shuffles again for every join."""
    sums = [
        part.drop("C_MONTH", "C_YEAR")
        for part in (margin_debt(margin), mblink_debt(debit), advance_withdraw(advances), traded_value(deals))
    ]
    return _with_labels(reduce(full_outer, sums))


def rows_of_days(df: DataFrame, date_column: str, first: dt.date, end: dt.date) -> DataFrame:
    """Rows whose business date lies in ``[first, end)``. Where ``partition_date`` is the day of that date, the
    predicate is repeated on it, so that other partitions are not read."""
    days = df.where(between_days(df, date_column, first, end))
    if "partition_date" in df.columns and date_column in PARTITION_DATES:
        days = days.where(between_days(df, "partition_date", first, end))
    return days


def back_data_days(
    margin: DataFrame, debit: DataFrame, advances: DataFrame, deals: DataFrame, first: dt.date, end: dt.date
) -> DataFrame:
    """``back_data`` of the days in ``[first, end)``: a daily run passes one day, a backfill years, both as one job."""
    return back_data(
        rows_of_days(margin, "C_TRADING_DATE", first, end),
        rows_of_days(debit, "C_TRANSACTION_DATE", first, end),
        rows_of_days(advances, "C_WITHDRAW_DATE", first, end),
        rows_of_days(deals, "C_TRANSACTION_DATE", first, end),
    )


def known_accounts(gold: DataFrame, accounts: DataFrame) -> DataFrame:
    """Gold rows whose account exists in the current accounts."""
    return gold.join(accounts.select("C_ACCOUNT_CODE"), "C_ACCOUNT_CODE", "left_semi").select(*gold.columns)


def write_account_days(gold: DataFrame, path: str, grain: str = "day", periods: list[dt.date] | None = None) -> None:
    """Replace the stored days (or months, years) that ``gold`` holds. A re-run does not duplicate rows.

    With a coarser grain than a day, ``gold`` has to hold whole periods. Given ``periods``, those that ``gold`` has no rows for
    are removed. Only accounts, dates and measures move; the labels, which follow from them, are added where rows are written.
    """
    part = f"partition_{grain}"
    rows = gold.select(*ACCOUNT_DAY, *MEASURES, period_start("C_DATE", grain).alias(part))
    rows = tables.gather(rows, [part])
    rows = publish(_with_labels(rows, part), schemas.struct(f"{schemas.BACK_DATA}, {part} date"))
    if periods is None:
        tables.overwrite_partitions(rows, path, [part], gathered=True)
    else:
        tables.replace_partitions(rows, path, part, [period.isoformat() for period in periods], gathered=True)


def front_data(changes: DataFrame, as_of: dt.date) -> DataFrame:
    """Traded value per account on the local day ``as_of``, in the columns of ``back_data``.

    ``changes`` is the deal change log. Of each deal only the newest version of the day counts, and none if that is a
    delete.
    """
    end = as_of + dt.timedelta(days=1)
    today = changes.where(
        between_days(changes, "partition_date", as_of, end) & between_days(changes, "updated_at", as_of, end)
    ).select("PK_FRONT_DEAL", "op", *VERSION_ORDER, "C_ACCOUNT_CODE", "C_MATCHED_PRICE", "C_MATCHED_VOLUME")
    deals = current_state(today, ["PK_FRONT_DEAL"], VERSION_ORDER, F.col("op") == DELETE)
    return front_data_of(deals, as_of)


def front_data_of(deals: DataFrame, as_of: dt.date) -> DataFrame:
    """Traded value per account of the current deals, dated ``as_of``."""
    sums = deals.groupBy("C_ACCOUNT_CODE").agg(F.sum(measures.traded_value(deals)).alias("C_GTGD"))
    return front_data_of_sums(sums, as_of)


def front_data_of_sums(sums: DataFrame, as_of: dt.date) -> DataFrame:
    """Account sums of traded value, dated ``as_of``, in the columns of ``back_data``."""
    zeros = [F.lit(0).alias(name) for name in MEASURES if name != "C_GTGD"]
    return _with_labels(sums.select("C_ACCOUNT_CODE", F.lit(as_of).alias("C_DATE"), *zeros, "C_GTGD"))


def erc_ranking(detail: DataFrame, kpi: bool = False) -> DataFrame:
    """Distinct customer rankings in the month in which they take effect; ``kpi`` adds the half-year label."""
    year, month = labels.effective_month(F.col("C_YEAR"), F.col("C_MONTH"))
    ranking = detail.select(
        "C_ORIGIN_ACCOUNT_CODE", year.alias("C_YEAR_ADJ"), month.alias("C_MONTH_ADJ"), "C_SYNTHETIC_ANNOUCED_RANKING"
    ).distinct()
    year, month = F.col("C_YEAR_ADJ"), F.col("C_MONTH_ADJ")
    added = {"C_RANKING_KEY": labels.ranking_key(F.col("C_ORIGIN_ACCOUNT_CODE"), year, month)}
    if kpi:
        added["C_KY_KPI"] = labels.kpi_period(year, month)
    return ranking.withColumns(added)


def erc_ranking_of_known(detail: DataFrame, accounts: DataFrame) -> DataFrame:
    """``erc_ranking`` with label, for origin accounts that have a current account.

    The distinct runs first: it leaves few rows per origin account, so the join has no large group.
    """
    origins = accounts.select(labels.origin_account(F.col("C_ACCOUNT_CODE")).alias("C_ORIGIN_ACCOUNT_CODE"))
    ranking = erc_ranking(detail, kpi=True)
    return ranking.join(origins, "C_ORIGIN_ACCOUNT_CODE", "left_semi").select(*ranking.columns)


def one_per_account(accounts: DataFrame) -> DataFrame:
    """Of the rows that share an account code the one changed last; rows without code go."""
    order = [name for name in VERSION_ORDER if name in accounts.columns]
    return latest_version(accounts.where(F.col("C_ACCOUNT_CODE").isNotNull()), ["C_ACCOUNT_CODE"], order)


def back_account_dim(accounts: DataFrame) -> DataFrame:
    """One row per current account, with branch and channel names."""
    return one_per_account(accounts).select(
        labels.origin_account(F.col("C_ACCOUNT_CODE")).alias("C_ORIGIN_ACCOUNT_CODE"),
        "C_ACCOUNT_CODE",
        "C_OPEN_DATE",
        labels.branch_name(F.col("C_ACCOUNT_BRANCH_CODE")).alias("C_BRANCH_NAME"),
        labels.channel_name(F.col("C_CHANNEL")).alias("C_CHANNEL_NAME"),
    )


def account_open_dates(accounts: DataFrame, open_dates: DataFrame) -> DataFrame:
    """One row per current account with the open date from the open-date view, the latest if that has several."""
    opened = open_dates.groupBy("C_ACCOUNT_CODE").agg(F.max("C_OPEN_DATE").alias("C_OPEN_DATE"))
    return one_per_account(accounts).drop("C_OPEN_DATE").join(opened, "C_ACCOUNT_CODE").select(
        "C_ACCOUNT_CODE", "C_OPEN_DATE", "C_ACCOUNT_BRANCH_CODE", "C_CHANNEL"
    )


def last_tick_per_day(ticks: DataFrame, zone: str = MARKET_ZONE) -> DataFrame:
    """Newest tick per index and local day."""
    local = ticks.select(
        "IndexCode", to_local(F.col("Last_updated"), zone).alias("trading_time"), "TotalValuesTraded"
    ).withColumn("C_DATE", F.to_date("trading_time"))
    return latest_version(local, ["IndexCode", "C_DATE"], ["trading_time"])


def market_turnover(ticks: DataFrame, zone: str = MARKET_ZONE) -> DataFrame:
    """Per local day, the sum over indices of the last cumulative traded value."""
    return last_tick_per_day(ticks, zone).groupBy("C_DATE").agg(
        F.sum("TotalValuesTraded").alias("total_market_value")
    )
