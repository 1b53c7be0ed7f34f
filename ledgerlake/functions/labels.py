"""Business labels: origin account, ranking key, half-year period, effective month, branch and channel names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: codes and the names they map to
ORIGIN_LENGTH = 6
BRANCH_CODE, BRANCH_NAME, OTHER_BRANCH_NAME = "17", "KDS", "SSG"
CHANNEL_CODE, CHANNEL_NAME, OTHER_CHANNEL_NAME = "MBB", "MB", "MBS"
FIRST_HALF, SECOND_HALF = " Ky 1", " Ky 2"


def origin_account(account: Column) -> Column:
    """First six characters; a shorter code is its own origin."""
    return F.substring(account, 1, ORIGIN_LENGTH)


def ranking_key(origin: Column, year: Column, month: Column) -> Column:
    """``origin_year_month`` without zero padding; NULL if a part is NULL."""
    return F.concat(origin, F.lit("_"), year.cast("string"), F.lit("_"), month.cast("string"))


def kpi_period(year: Column, month: Column) -> Column:
    """Half-year label such as ``2024 Ky 1``. A NULL month belongs to the second half, as in the source system."""
    return F.concat(year.cast("string"), F.when(month.between(1, 6), FIRST_HALF).otherwise(SECOND_HALF))


def effective_month(year: Column, month: Column) -> tuple[Column, Column]:
    """(year, month) in which a ranking of the given month takes effect: the month after it."""
    year, month = year.cast("int"), month.cast("int")
    in_december = month == 12
    return F.when(in_december, year + 1).otherwise(year), F.when(in_december, F.lit(1)).otherwise(month + 1)


def branch_name(code: Column) -> Column:
    return F.when(code == BRANCH_CODE, BRANCH_NAME).otherwise(OTHER_BRANCH_NAME)


def channel_name(code: Column) -> Column:
    return F.when(code == CHANNEL_CODE, CHANNEL_NAME).otherwise(OTHER_CHANNEL_NAME)
