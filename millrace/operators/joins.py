"""Lookup joins that stay correct and balanced whatever the size of the lookup or the key skew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import staged

# A lookup is broadcast only after its rows and bytes have been counted: at most this many of either.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
# Beyond that, a key holding more than 1/HOT_SHARE of the left rows is spread over SALTS tasks.
HOT_SHARE = 64
SALTS = 64


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: text by its length, nested values by their JSON, others 8."""
    size = F.lit(8 * len(df.columns))
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{name}`")))), F.lit(0))
    return size


def _measured(df: DataFrame, tag: int = 0) -> DataFrame:
    """One row ``i, n, bytes``; every task sends one partial sum."""
    return df.agg(F.lit(tag).alias("i"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"))


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` is counted to have at most ``max_rows`` rows and ``BROADCAST_BYTES`` bytes."""
    return which_fit([df], max_rows)[0]


def which_fit(dfs: Sequence[DataFrame], max_rows: int = BROADCAST_ROWS) -> list[bool]:
    """:func:`fits_broadcast` for several lookups in one job."""
    if not dfs:
        return []
    rows = reduce(DataFrame.union, [_measured(d, i) for i, d in enumerate(dfs)]).collect()
    sizes = {r["i"]: r for r in rows}
    return [sizes[i]["n"] <= max_rows and sizes[i]["bytes"] <= BROADCAST_BYTES for i in range(len(dfs))]


def _same_key(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return cond


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``1/share`` of the rows, so fewer than ``share`` rows come back.

    Counting combines on the map side, so a hot key costs one row per input partition.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.filter(F.col("_n") * share > total).select(*keys)


def hot_values(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> tuple[dict[str, DataFrame], set[str]]:
    """:func:`hot_keys` of several single keys from one pass over ``df``, written: fewer than ``share`` rows
    a key, which plans built on it read instead of ``df``. Second: the keys that have no other values (but null)."""
    kinds = {k: df.schema[k].dataType for k in keys}
    each = df.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("name"), F.col(k).cast("string").alias("value")) for k in keys])).alias("p"))
    counts = each.groupBy("p.name", "p.value").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.filter(F.col("name") == keys[0]).agg(F.sum("_n")).scalar()
    marked = counts.withColumn("_hot", F.coalesce(F.col("_n") * share > total, F.lit(False)))
    # all values of a key that are not hot are one row
    kept = staged(marked.groupBy("name", "_hot", F.when(F.col("_hot"), F.col("value")).alias("value")).agg(
        F.count_if(~F.col("_hot") & F.col("value").isNotNull()).alias("_others")), "hot-keys")
    mixed = {r["name"] for r in kept.filter("_others > 0").select("name").collect()}
    hot = kept.filter("_hot")
    return {k: hot.filter(F.col("name") == k).select(F.col("value").cast(kinds[k]).alias(k)) for k in keys}, set(keys) - mixed


def spread_salt(df: DataFrame, salts: int = SALTS) -> Column:
    """A salt that separates rows of one key: by map partition and by row content.

    The partition number keeps exact copies apart, the content keeps rows of one partition apart.
    Both are the same when a lost task runs again.
    """
    plain = [c for c, t in df.dtypes if not t.startswith("map")]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *plain), F.lit(salts)).cast("int")


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                share: int = HOT_SHARE, salts: int = SALTS, hot: DataFrame | None = None) -> DataFrame:
    """Equi-join for two large sides: hot left keys are spread, their right rows replicated.

    Only the few hot keys are replicated. Null keys match nothing and are spread as well. ``hot``
    are the keys to spread where they are known; else they are counted and written first, so that
    ``left`` stands once in the plan.
    """
    if hot is None:
        hot = staged(hot_keys(left, keys, share), "hot-keys")
    marks = F.broadcast(hot.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
                        .withColumn("_hot", F.lit(True)))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    spread = (left.join(marks, _same_key(keys), "left")
              .withColumn("_salt", F.when(F.col("_hot") | no_key, spread_salt(left, salts))
                          .otherwise(0))
              .drop("_hot", *[f"_r_{k}" for k in keys]))
    copies = (right.join(marks, _same_key(keys), "left")
              .withColumn("_salt", F.explode(
                  F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                  .otherwise(F.array(F.lit(0)))))
              .drop("_hot", *[f"_r_{k}" for k in keys]))
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")


def lookup_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "left",
                max_rows: int = BROADCAST_ROWS, fits: bool | None = None) -> DataFrame:
    """Join ``left`` to a lookup with at most one row per key (``left``, ``inner``, ``left_semi``
    or ``left_anti``): broadcast when the lookup is counted small, salted otherwise.

    ``fits`` is the answer of a check already made."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if fits_broadcast(right, max_rows) if fits is None else fits:
        return left.join(F.broadcast(right), keys, how)
    return salted_join(left, right, keys, how)


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, dict[str, str]]],
              max_rows: int = BROADCAST_ROWS, keys: DataFrame | None = None, by: str | None = None) -> DataFrame:
    """Left join a fact to dimensions. Each entry is (dimension, key, {column: output name});
    only the named columns are read from the dimension. The hot keys of all large dimensions come from
    one pass over the fact, so every dimension adds one scan to the plan; where all values of a key are hot, their
    few rows are broadcast and the fact is not shuffled for it. ``keys`` is a cheaper table with every key of ``fact``, where
    there is one. With its column ``by``, the one that ``fact`` lies by, it is written, joined to the large dimensions
    in place of ``fact``, and meets it by that column; it then has every combination of ``by`` and keys in ``fact``."""
    picked = [d.select(key, *[F.col(c).alias(n) for c, n in names.items()]) for d, key, names in dims]
    fitting = which_fit(picked, max_rows)
    large = sorted({key for fits, (_, key, _) in zip(fitting, dims) if not fits})
    if keys is not None and by and large:
        keys = staged(keys.select(by, *large), "star-keys")
    hot, only_hot = hot_values(fact if keys is None else keys, large) if large else ({}, set())
    salted = [k for k in large if k not in only_hot]
    out = fact
    named = keys.select(by, *salted) if keys is not None and by and salted else None
    for dim, fits, (_, key, _) in zip(picked, fitting, dims):
        if fits:
            out = out.join(F.broadcast(dim), key, "left")
        elif key in only_hot:
            out = out.join(F.broadcast(dim.join(F.broadcast(hot[key]), key, "left_semi")), key, "left")
        elif named is not None:
            named = salted_join(named, dim, [key], hot=hot[key])
        else:
            out = salted_join(out, dim, [key], hot=hot[key])
    return out if named is None else _meet(out, named, by, salted)


def _meet(fact: DataFrame, named: DataFrame, by: str, keys: Sequence[str]) -> DataFrame:
    """``fact`` with the columns that ``named`` has for its ``by`` and keys. The keys are compared beside the join, not joined
    on, so that a fact that lies by ``by`` is not shuffled."""
    once = named.repartition(by).distinct().withColumnsRenamed({k: f"_r_{k}" for k in (by, *keys)})
    same = F.col(by) == F.col(f"_r_{by}")
    for k in keys:
        left, right = F.col(k), F.col(f"_r_{k}")
        same = same & F.coalesce(left == right, left.isNull() & right.isNull())
    return fact.join(once, same, "left").drop(*[f"_r_{k}" for k in (by, *keys)])


def flag_members(df: DataFrame, members: DataFrame, column: str, ref_column: str, flag: str,
                 max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add boolean ``flag``: whether ``column`` occurs in ``members.ref_column`` (null: false)."""
    keys = (members.select(F.col(ref_column).alias(column)).filter(F.col(column).isNotNull())
            .distinct().withColumn(flag, F.lit(True)))
    return (lookup_join(df, keys, column, "left", max_rows)
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def unknown_keys(df: DataFrame, members: DataFrame, column: str, ref_column: str,
                 max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The distinct values of ``column`` that do not occur in ``members.ref_column``, written. Only keys are read and shuffled."""
    keys, held = (d.filter(F.col(column).isNotNull()).distinct()
                  for d in (df.select(column), members.select(F.col(ref_column).alias(column))))
    return staged(keys.join(F.broadcast(held) if fits_broadcast(held, max_rows) else held, column, "left_anti"), "unknown-keys")


def flag_unless(df: DataFrame, unknown: DataFrame, column: str, flag: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """:func:`flag_members` from the :func:`unknown_keys`: while these are few, no row of ``df`` is shuffled."""
    if unknown.isEmpty():
        return df.withColumn(flag, F.col(column).isNotNull())
    found = lookup_join(df, unknown.withColumn(flag, F.lit(False)), column, "left", max_rows)
    return found.withColumn(flag, F.coalesce(F.col(flag), F.col(column).isNotNull()))


def not_in_target(batch: DataFrame, target: DataFrame, keys: Sequence[str],
                  max_rows: int = BROADCAST_ROWS, wanted: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` yet.

    The target is usually far larger than the batch. A small batch is sent to the target scan to
    find the keys already there (at most one row per batch key), so the target is not shuffled.
    ``wanted`` is a cheaper table with the keys of ``batch`` (or more), where there is one.
    """
    keys = list(keys)
    wanted = (batch if wanted is None else wanted).select(*keys).distinct()
    if not fits_broadcast(wanted, max_rows):
        return batch.join(target.select(*keys), keys, "left_anti")
    present = staged(target.select(*keys).join(F.broadcast(wanted), keys, "left_semi").distinct(), "present")
    return batch.join(F.broadcast(present), keys, "left_anti")


def only_for(df: DataFrame, wanted: DataFrame, key: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of a large table whose key occurs in ``wanted``: few keys are sent to the scan."""
    keys = wanted.select(key).filter(F.col(key).isNotNull()).distinct()
    return lookup_join(df, keys, key, "left_semi", max_rows)
