"""Masks and hashes for personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: pattern and replacement per mask ------------------------------------------
REDACTED = "[REDACTED]"
PATTERN_MASKS = {
    "partial_email": (r"^[^@]+", "***"),
    "partial_prefix_3": (r"^(.{3}).*", "$1********"),
    "last_four": (r"^.*(.{4})$", "************$1"),
}
# ---------------------------------------------------------------------------------------------


def pii_hash(c: Column) -> Column:
    """Hex MD5 of the text form; null stays null."""
    return F.md5(c.cast("string"))


def mask(c: Column, mode: str) -> Column:
    if mode == "redact":
        return F.lit(REDACTED)
    if mode == "hash":
        return pii_hash(c)
    if mode in PATTERN_MASKS:
        pattern, replacement = PATTERN_MASKS[mode]
        return F.regexp_replace(c.cast("string"), pattern, replacement)
    raise ValueError(f"unknown mask {mode!r}")


def mask_columns(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    """Apply one mask per column; columns the table lacks are skipped."""
    present = {n: m for n, m in modes.items() if n in df.columns}
    return df.withColumns({n: mask(F.col(n), m) for n, m in present.items()})


def hash_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """MD5 the named columns, matching names without regard to case."""
    wanted = {n.lower() for n in names}
    return df.withColumns({n: pii_hash(F.col(n)) for n in df.columns if n.lower() in wanted})
