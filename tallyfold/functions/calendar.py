"""Dates, periods and look-back windows.

Nothing here reads the clock except ``business_date``: callers pass ``as_of``
so that a rerun gives the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

BUSINESS_ZONE = "Asia/Kolkata"


def as_timestamp(as_of: str | dt.date | dt.datetime | Column) -> Column:
    return (as_of if isinstance(as_of, Column) else F.lit(str(as_of))).cast("timestamp")


def date_dim_id(column: Column) -> Column:
    return F.date_format(column, "yyyyMMdd")


def year_month(column: Column) -> Column:
    return F.date_format(column, "yyyyMM")


def epoch_millis_to_timestamp(column: Column) -> Column:
    return F.timestamp_millis(column)


def calendar_columns(column: Column) -> dict[str, Column]:
    """Integer ``year``, ``month`` and ``day`` of a date or timestamp."""
    return {"year": F.year(column), "month": F.month(column), "day": F.dayofmonth(column)}


def lookback_start(as_of, months: int) -> Column:
    """First day of the month ``months`` before the month of ``as_of``."""
    return F.add_months(F.trunc(as_timestamp(as_of).cast("date"), "month"), -months)


def in_lookback(as_of, months: int, *, period: str = "bill_billing_period_start_date") -> Column:
    """Billing period and partition month both inside the look-back.

    The second half only touches partition columns, so it prunes directories.
    """
    start = lookback_start(as_of, months)
    return (F.col(period) >= start) & (F.make_date(F.col("year"), F.col("month"), F.lit(1)) >= start)


def in_time_range(column: Column, as_of, *, older_than_hours: int, newer_than_hours: int) -> Column:
    """Strictly between ``newer_than_hours`` and ``older_than_hours`` before ``as_of``."""
    now = as_timestamp(as_of)
    return (column < now - F.expr(f"INTERVAL {int(older_than_hours)} HOURS")) & (
        column > now - F.expr(f"INTERVAL {int(newer_than_hours)} HOURS")
    )


def business_date(zone: str = BUSINESS_ZONE, days_back: int = 0) -> Column:
    """Today in the business zone, or ``days_back`` days earlier."""
    return F.date_sub(F.from_utc_timestamp(F.current_timestamp(), zone).cast("date"), days_back)


def reporting_period(as_of: dt.date, *, history: bool = False) -> tuple[dt.date, dt.date]:
    """Commitment reporting period: the day before ``as_of``, or a year back."""
    if not history:
        return as_of - dt.timedelta(days=1), as_of
    try:
        return as_of.replace(year=as_of.year - 1), as_of
    except ValueError:  # 29 February
        return as_of.replace(year=as_of.year - 1, day=28), as_of
