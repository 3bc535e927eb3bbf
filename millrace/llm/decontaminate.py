"""Benchmark decontamination: test passages found in training texts, and their removal.

Both sides are cut into words of letters, digits and characters outside ASCII, in lower case. The
hash set holds short grams of the test windows. A document is sampled at a stride at which every
window that occurs in it must show one of these grams; a document that shows one is searched for
the whole windows, word for word. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import staged

WINDOW = 13
# Sides of joins are sent to all executors up to this many rows of a few words each; larger ones
# are shuffled instead.
BROADCAST_ROWS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, _BETWEEN), "")


def _small(df: DataFrame) -> DataFrame:
    """``df``, written already, with a broadcast hint if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _windows(words: Column, size: Column) -> Column:
    """Places (start, window) of all runs of ``size`` words."""
    return F.when(F.size(words) >= size, F.transform(
        F.sequence(F.lit(1), F.size(words) - size + 1),
        lambda i: F.struct((i - 1).alias("start"), F.array_join(F.slice(words, i, size), " ").alias("window"))))


def test_windows(items: DataFrame, key: str, text: str, window: int = WINDOW) -> DataFrame:
    """``item, size, window`` of every item: its runs of ``window`` words, or its whole sequence if it
    is shorter. Items without words have none."""
    rows = items.select(F.col(key).alias("item"), words_of(F.col(text)).alias("words")).filter(F.size("words") > 0)
    size = F.least(F.lit(window), F.size("words"))
    return (rows.select("item", size.alias("size"), F.explode(_windows(F.col("words"), size)).alias("w"))
            .select("item", "size", F.col("w.window").alias("window")).distinct())


def _gram_size(size: Column) -> Column:
    """Half a window, rounded up: the gram shown at one of ``size - gram + 1`` places in a row."""
    return F.floor((size + 1) / 2).cast("int")


def find_passages(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", window: int = WINDOW
                  ) -> tuple[DataFrame, DataFrame]:
    """``(documents, hits)``.

    ``documents``: ``key, _copy, n_words`` for every row of ``docs``. ``hits``: ``key, _copy, starts,
    items``: where windows begin (word from 0, number of words) and the items they come from.
    ``_copy`` is a hash of the text, so rows that share an id are kept apart unless they are equal.
    Null and empty texts and items have no words and no windows; keys may be null.
    """
    wanted = staged(test_windows(items, item_key, item_text, window), "test-windows")
    sizes = [r["size"] for r in wanted.select("size").distinct().collect()]  # at most ``window`` values
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(F.col(text)).alias("_copy"), F.col(text).alias("_text"))

    grams = wanted.select("size", F.split("window", " ").alias("w")).select(
        "size", F.explode(F.transform(F.sequence(F.lit(1), F.col("size") - _gram_size(F.col("size")) + 1),
                                      lambda i: F.xxhash64(F.slice("w", i, _gram_size(F.col("size")))))).alias("gram"))
    grams = staged(grams.select("gram").distinct(), "test-grams")

    def sampled(size: int) -> Column:
        short = (size + 1) // 2
        places = F.sequence(F.lit(1), F.size("words") - short + 1, F.lit(size - short + 1))
        return F.when(F.size("words") >= size, F.transform(places, lambda i: F.xxhash64(F.slice("words", i, short))))

    shown = F.concat(F.array().cast("array<bigint>"), *[F.coalesce(sampled(s), F.array().cast("array<bigint>"))
                                                       for s in sizes])
    scanned = staged(rows.withColumn("words", words_of(F.col("_text")))
                     .select("_key", "_copy", F.size("words").cast("bigint").alias("n_words"), shown.alias("shown")),
                     "scanned-texts")
    marked = staged(scanned.select("_key", "_copy", F.explode("shown").alias("gram"))
                    .join(_small(grams), "gram", "left_semi").select("_key", "_copy").distinct(), "marked-texts")

    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_copy") == F.col("_c"))
    named = marked.select(F.col("_key").alias("_k"), F.col("_copy").alias("_c"))
    suspects = (rows.join(_small(named), same, "left_semi").dropDuplicates(["_key", "_copy"])
                .select("_key", "_copy", words_of(F.col("_text")).alias("words")))
    places = F.concat(*[F.coalesce(F.transform(_windows(F.col("words"), F.lit(s)), lambda p: F.struct(
        p["start"].alias("start"), F.lit(s).alias("size"), p["window"].alias("window"))), F.array())
        for s in sizes or [window]])
    exact = _small(wanted.groupBy("size", "window").agg(F.collect_set("item").alias("which")))
    hits = (suspects.select("_key", "_copy", F.explode(places).alias("p")).select("_key", "_copy", "p.*")
            .join(exact, ["size", "window"])
            .groupBy("_key", "_copy").agg(F.collect_set(F.struct("start", "size")).alias("starts"),
                                          F.array_distinct(F.flatten(F.collect_set("which"))).alias("items")))
    return (scanned.select(F.col("_key").alias(key), "_copy", "n_words"),
            staged(hits.select(F.col("_key").alias(key), "_copy", "starts", "items"), "passages"))


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``key, _copy, n_words, n_hit, items, contaminated``. A word is hit
    inside any window found; a document is contaminated if a twentieth of its words or more are hit."""
    every, hits = find_passages(docs, items, key, text, item_key, item_text, window)
    spread = F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(
        p["start"], p["start"] + p["size"] - 1))))
    hits = hits.select(F.col(key).alias("_k"), F.col("_copy").alias("_c"), F.size(spread).cast("bigint").alias("hit"), "items")
    n_hit = F.coalesce("hit", F.lit(0).cast("bigint"))
    return (every.join(hits, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_copy") == F.col("_c")), "left")
            .select(key, "_copy", "n_words", n_hit.alias("n_hit"), "items",
                    ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated")))


def without_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the contaminated documents, all columns kept."""
    bad = staged(contamination(docs, items, key, text).filter("contaminated")
                 .select(F.col(key).alias("_k"), F.col("_copy").alias("_c")).distinct(), "contaminated")
    return docs.join(_small(bad), docs[key].eqNullSafe(bad["_k"]) & (F.xxhash64(docs[text]) == bad["_c"]), "left_anti")


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    items = F.array_sort(F.transform(F.coalesce("items", F.array()), lambda i: i.cast("string")))
    return found.select(key, "n_words", "n_hit", F.size(items).cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated")
