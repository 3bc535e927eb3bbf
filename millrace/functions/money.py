"""Exact money and percentage arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column) -> Column:
    """``DECIMAL(18,2)``, null where the value does not fit."""
    return c.try_cast("decimal(18,2)")


def money_or_zero(c: Column) -> Column:
    return F.coalesce(money(c), F.lit(0).cast("decimal(18,2)"))


def ratio(part: Column, whole: Column, places: int = 2) -> Column:
    """``part / whole`` rounded half up from an exact decimal quotient, null when whole is 0."""
    top, bottom = part.cast("decimal(28,2)"), F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    return F.round(top / bottom, places).cast("double")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; both are counts."""
    top, bottom = part.cast("decimal(18,0)") * 100, F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    return F.round(top / bottom, places).cast("double")


def cents(c: Column) -> Column:
    """Whole cents, null where they do not fit."""
    return F.bround(c.try_cast("decimal(24,6)") * 100, 0).try_cast("bigint")


def refund_pct(refund: Column, total: Column) -> Column:
    """Refund as a percent of the order total, ``DECIMAL(5,2)``, rounded half up.

    Null when the total is missing or 0, and where the percentage does not fit the type. Runs once
    per ticket, so it works on whole cents in 64-bit arithmetic.
    """
    part, whole = F.coalesce(cents(refund), F.lit(0)), F.nullif(cents(total), F.lit(0))
    size = F.call_function("div", F.try_add(F.try_multiply(F.abs(part), F.lit(20_000)), F.abs(whole)),
                           F.abs(whole) * 2)
    hundredths = F.when((part < 0) != (whole < 0), -size).otherwise(size)
    return (hundredths / 100).try_cast("decimal(5,2)")
