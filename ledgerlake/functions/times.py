"""Time expressions. Stored times are UTC without zone (``timestamp_ntz``), so results do not depend on the session
zone; one zone parameter turns them into local time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKET_ZONE = "Asia/Ho_Chi_Minh"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def utc_from_millis(millis: Column) -> Column:
    """Epoch milliseconds as UTC time, milliseconds kept."""
    return F.timestamp_add("MILLISECOND", millis, ntz("1970-01-01 00:00:00"))


def to_local(utc: Column, zone: str = MARKET_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz"))


def local_from_millis(millis: Column, zone: str = MARKET_ZONE) -> Column:
    return to_local(utc_from_millis(millis), zone)


def between_days(df: DataFrame, column: str, first: dt.date, end: dt.date) -> Column:
    """``first <= column < end`` with bounds of the column's own type, so that the predicate reaches the scan."""
    column_type = df.schema[column].dataType
    lower, upper = (F.lit(day.isoformat()).cast(column_type) for day in (first, end))
    return (F.col(column) >= lower) & (F.col(column) < upper)


def period_start(column: str, grain: str) -> Column:
    """First day of the day, month or year of a date or time."""
    return F.to_date(column) if grain == "day" else F.trunc(F.to_date(column), grain)


def as_utc(instant: Column) -> Column:
    """An instant (``timestamp``) as UTC time without zone, whatever the session zone."""
    return F.convert_timezone(None, F.lit("UTC"), instant)


def as_instant(utc: Column) -> Column:
    """UTC time without zone as an instant, whatever the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), utc).cast("timestamp")


def year_range(year: int) -> tuple[dt.date, dt.date]:
    return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)


def previous_month(as_of: dt.date) -> tuple[int, int]:
    """(year, month) before the month of ``as_of``."""
    last = as_of.replace(day=1) - dt.timedelta(days=1)
    return last.year, last.month
