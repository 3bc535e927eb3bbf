"""Surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import lookup_join
from millrace.session import staged

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def number_rows(df: DataFrame, order: str | Sequence[str], name: str,
                base: DataFrame | int = 0) -> DataFrame:
    """``base + row_number() over (order by ...)`` computed range by range.

    Rows are range partitioned and sorted, numbered inside each range, and shifted by the number of
    rows in earlier ranges. The ranges come from sampling, so the numbered rows are written once:
    both passes and any retry then see the same ranges. The offset table has one row per range.
    ``base`` is a number or a one-row DataFrame, read as a scalar subquery.
    """
    order = [order] if isinstance(order, str) else list(order)
    ranged = staged(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_pos", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_pos", _ROW_BITS)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    numbered = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    start = base.scalar() if isinstance(base, DataFrame) else F.lit(base)
    key = (start + F.col("_offset") + local).cast("bigint")
    return numbered.select(key.alias(name), *df.columns)


def number_by_key(df: DataFrame, key: str, name: str, base: DataFrame | int = 0) -> DataFrame:
    """:func:`number_rows` for rows with a unique, non-null ``key``: only the keys are ranged and
    written, and the rows get their number by a join on the key."""
    numbers = number_rows(df.select(key), key, name, base)
    return df.join(numbers, key).select(name, *df.columns)


def max_key(df: DataFrame, name: str) -> DataFrame:
    """One row: the highest key in use, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint").alias("base_sk"))


def stable_keys(rows: DataFrame, known: DataFrame, natural: str, name: str) -> DataFrame:
    """Surrogate keys that survive upserts: known natural keys keep theirs, new ones are numbered
    after the highest key in use, in natural-key order."""
    held = lookup_join(rows, known.select(natural, name), natural, "left")
    kept = held.filter(F.col(name).isNotNull()).select(name, *rows.columns)
    fresh = held.filter(F.col(name).isNull()).select(*rows.columns)
    return kept.unionByName(number_by_key(fresh, natural, name, max_key(known, name)))
