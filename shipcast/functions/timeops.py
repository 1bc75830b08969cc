"""Durations and calendar fields (PRJ-01, 03, 05, 06, 09)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86400e6


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def frac_days(end, start) -> Column:
    """Fractional days between two timestamps; NULL if either is NULL (PRJ-01)."""
    return (F.unix_micros(_c(end)) - F.unix_micros(_c(start))) / MICROS_PER_DAY


def floor_days(end, start) -> Column:
    """Whole days, floored like a timedelta's ``days`` (-12 h -> -1) (PRJ-03/05/09)."""
    return F.floor(frac_days(end, start))


def month(ts) -> Column:
    return F.month(_c(ts))


def weekday(ts) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts))


def hour(ts) -> Column:
    return F.hour(_c(ts))


def quarter(ts) -> Column:
    return F.quarter(_c(ts))


def is_weekend(ts) -> Column:
    return (F.weekday(_c(ts)) >= 5).cast("int")


def year_month(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM")
