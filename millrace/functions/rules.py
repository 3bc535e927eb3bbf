"""Column rules: text clean-up, typed reading, and the per-value checks of a contract.

Every function returns a Column built from JVM expressions. Patterns end in ``\\z`` because ``$``
also matches before a trailing newline in Java.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values ---------------------------------------------------------------------------
BLANK_TOKENS = ("", "NaN", "nan")
NULL_TOKENS = ("", "NULL", "null", "None", "NA", "N/A")

TYPE_PATTERNS = {
    "integer": r"^-?\d+(\.0*)?\z",
    "float": r"^-?\d+(\.\d+)?([eE][-+]?\d+)?\z",
    "boolean": r"^(?i:true|false|0|1)\z",
    "timestamp": r"^\d{4}-\d{2}-\d{2}.*\z",
    "date": r"^\d{4}-\d{2}-\d{2}\z",
}

# row rule and report rule use different patterns; the report ones are looser
ROW_FORMATS = {
    "email": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z",
    "phone": r"^0\d{10}\z",
}
REPORT_FORMATS = {
    "email": r"^[^@\s]+@[^@\s]+\.[^@\s]+\z",
    "phone": r"^\+?[\d\s\-().]{7,20}\z",
}
# ---------------------------------------------------------------------------------------------


def null_tokens(c: Column, tokens: Sequence[str] = BLANK_TOKENS) -> Column:
    """Text with the given spellings of "no value" turned into null."""
    return F.when(~F.trim(c).isin(*tokens), c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def try_type(c: Column, to: str) -> Column:
    """Cast to a contract type, null where the value does not fit. ``c`` is text."""
    if to == "integer":
        # decimal first: sources write 12 as "12.0" once a column has held a null
        whole = c.try_cast("decimal(38,6)").try_cast("bigint")
        return F.when(c.rlike(TYPE_PATTERNS["integer"]), whole)
    if to == "float":
        return F.when(c.rlike(TYPE_PATTERNS["float"]), c.try_cast("double"))
    if to == "boolean":
        return F.when(c.rlike(TYPE_PATTERNS["boolean"]), c.try_cast("boolean"))
    if to == "timestamp":
        return F.when(c.rlike(TYPE_PATTERNS["timestamp"]), c.try_cast("timestamp_ntz"))
    if to == "date":
        return F.when(c.rlike(TYPE_PATTERNS["date"]), c.try_cast("date"))
    return c


def typed(c: Column, have: T.DataType, to: str) -> Column:
    """Like :func:`try_type` for a column that may already be typed (a Parquet source)."""
    if isinstance(have, T.StringType):
        return try_type(c, to)
    want = {"integer": "bigint", "float": "double", "boolean": "boolean",
            "timestamp": "timestamp_ntz", "date": "date"}.get(to, "string")
    if to == "integer" and isinstance(have, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.when(c == F.floor(c), c.try_cast(want))
    return c.try_cast(want)


def bad_type(raw: Column, value: Column) -> Column:
    return raw.isNotNull() & value.isNull()


def bad_format(c: Column, pattern: str) -> Column:
    return c.isNotNull() & ~c.rlike(pattern)


def bad_enum(c: Column, allowed: Sequence[str]) -> Column:
    return c.isNotNull() & ~c.cast("string").isin(*allowed)


def bad_range(c: Column, lo: float | None, hi: float | None, bounds: str = "exclusive") -> Column:
    """Out of range. ``exclusive`` rejects a value equal to a bound, ``inclusive`` accepts it."""
    tests = []
    if lo is not None:
        tests.append(c <= lo if bounds == "exclusive" else c < lo)
    if hi is not None:
        tests.append(c >= hi if bounds == "exclusive" else c > hi)
    broken = tests[0]
    for t in tests[1:]:
        broken = broken | t
    return F.coalesce(broken, F.lit(False))
