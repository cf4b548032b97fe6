"""Scalar rules as built-in column expressions; nothing here leaves the JVM."""
from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F

from meterline.schemas import MONEY


INFINITY = float("inf")


def finite(value: Column) -> Column:
    """True for ordinary numbers, false for infinities and NaN, null for null.

    One comparison does it: Spark orders NaN above infinity.
    """
    return F.abs(value) < F.lit(INFINITY)


def finite_from(value: Column, least: Column) -> Column:
    """Finite and not below `least`; the same null rule."""
    return (value >= least) & (value < F.lit(INFINITY))


def whole(value: Column) -> Column:
    """True when a double has no fractional part.

    `rint` stays in doubles, where `floor` would go through bigint and turn
    NaN into 0.
    """
    return value == F.rint(value)


def unless(condition: Column) -> Column:
    """True where the condition is false or null."""
    return ~F.coalesce(condition, F.lit(False))


def or_false(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def wall_clock_second(ts: Column) -> Column:
    """Whole seconds of a zone-less timestamp since 1970-01-01.

    Built from date and time fields, so the session time zone and its
    daylight-saving changes never move a local wall-clock value.
    """
    days = F.unix_date(ts.cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def minutes_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end, in minutes (double)."""
    return (wall_clock_second(end) - wall_clock_second(start)) / F.lit(60.0)


def period_of(ts: Column) -> Column:
    """`yyyy-MM` of a date or zone-less timestamp."""
    return F.substring(ts.cast("date").cast("string"), 1, 7)


def money(amount: Column) -> Column:
    """Double -> decimal(18,2), rounding the scaled double half away from zero.

    A direct cast rounds the printed decimal instead, which differs for inputs
    finer than a cent (1.005 is stored below 1.005 and must become 1.00).
    """
    cents = F.round(amount * F.lit(100.0), 0).cast("decimal(18,0)")
    return (cents * F.lit(Decimal("0.01"))).cast(MONEY)


def days_in_month(date: Column) -> Column:
    return F.dayofmonth(F.last_day(date))
