"""Clock arithmetic: minute differences, SLA flags, role-playing date and time keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end (10:00:59 to 10:01:00 is one)."""
    return (F.datediff(end, start).cast("bigint") * 1440
            + (F.hour(end) - F.hour(start)) * 60 + (F.minute(end) - F.minute(start)))


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Minutes crossed, never below zero, null while either side is missing.

    ``greatest`` skips nulls, so the guard keeps an open ticket null instead of zero.
    """
    gap = minutes_between(start, end)
    return F.when(end.isNotNull(), F.greatest(gap, F.lit(0)))


def breached(minutes: Column, limit: Column | float, happened: Column) -> Column:
    """True/false once the event happened, null before."""
    return F.when(happened.isNotNull(), minutes > limit)


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")


def time_key(ts: Column) -> Column:
    """Minute of day, 0 to 1439."""
    return (F.hour(ts) * 60 + F.minute(ts)).cast("int")


def parse_iso(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss"))
