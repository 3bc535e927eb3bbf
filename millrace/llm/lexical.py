"""Ranked lexical search without an index of the documents.

The terms of all items form one Aho-Corasick automaton. It runs over the texts themselves, every pattern
guarded by a blank at both ends and every separator of a text folded to a blank, so that only whole terms
match. Its outputs are term numbers, which lead to the items holding the term. One pass counts, the
statistics of all documents follow from the counts, and a second pass over the counts alone keeps the best
documents of every item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.bytewords import ALNUM, LOWER
from millrace.session import staged

SLICE_BYTES = 4 << 20   # terms of one automaton, counted for every item that holds them
PIECE_BYTES = 1 << 20   # text searched at once
ENTRIES = 1 << 21       # (document, term, item) entries scored at once
CELLS = 1 << 22         # (document, item) scores held at once
SALTS = 64
SATURATION, LENGTH_SHARE = 20, 50
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after A-Z are lower case
_FOLD = bytes(int(low) if ALNUM[low] else 32 for low in LOWER)


def terms_of(text: Column) -> Column:
    """Different terms of a text, A-Z in lower case; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.filter(F.split(low, _SEPARATORS), lambda t: t != ""))


@dataclass
class Vocabulary:
    """Terms of some items: the items' ids, the terms, and for term ``t`` the items
    ``holders[first[t]:first[t + 1]]``."""

    items: list
    terms: list[str]
    first: np.ndarray
    holders: np.ndarray

    @classmethod
    def of(cls, pairs: list[tuple]) -> Vocabulary:
        """From (item, term) pairs, each once."""
        items = {i: n for n, i in enumerate(dict.fromkeys(i for i, _ in pairs))}
        terms = {t: n for n, t in enumerate(dict.fromkeys(t for _, t in pairs))}
        of = np.array([terms[t] for _, t in pairs], np.int64)
        order = np.argsort(of, kind="stable")
        holders = np.array([items[i] for i, _ in pairs], np.int64)[order]
        return cls(list(items), list(terms), np.searchsorted(of[order], np.arange(len(terms) + 1)), holders)


def automaton(terms: list[str]):
    """Automaton over folded bytes, each taken as one character."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        machine.add_word(f" {term.encode().decode('latin-1')} ", number)
    machine.make_automaton()
    return machine


def pieces(data: bytes) -> Iterator[bytes]:
    """A text with its separators folded to blanks, in pieces that begin and end with one and part no term."""
    folded = b" " + data.translate(_FOLD) + b" "
    at = 0
    while at < len(folded) - 1:
        end = folded.find(b" ", min(at + PIECE_BYTES, len(folded) - 1))
        yield folded[at:end + 1]
        at = end


def count_terms(machine, data: bytes) -> tuple[int, Counter]:
    """All terms of a text, and how often each term of the automaton stands in it."""
    n, found = 0, Counter()
    for piece in pieces(data):
        inside = np.frombuffer(piece, np.uint8) != 32
        n += int(np.count_nonzero(inside[1:] & ~inside[:-1]))
        found.update(map(itemgetter(1), machine.iter(piece.decode("latin-1"))))
    return n, found


def _counted(docs: DataFrame, key: str, text: str, terms: list[str]) -> DataFrame:
    """``key, n, terms, tfs`` of every document."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("data"))
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        machine = automaton(shared.value)
        for batch in batches:
            sizes, offsets, found, tfs = [], [0], [], []
            for data in batch.column("data"):
                n, counts = count_terms(machine, data.as_py() or b"")
                sizes.append(n)
                found += counts.keys()
                tfs += counts.values()
                offsets.append(len(found))
            cut = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(cut, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(cut, pa.array(tfs, pa.int64()))], ["key", "n", "terms", "tfs"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n bigint, terms array<int>, tfs array<bigint>")


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_factor(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """``m`` of documents of ``n`` terms; beyond 64 bits by Python integers."""
    wide = int(n.max(initial=0)) * documents * LENGTH_SHARE >= 1 << 63
    n = n.astype(object) if wide else n
    return (100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // length).astype(np.int64)


class _Best:
    """The ``k`` best documents of every item so far, ties to the smaller key, no key last."""

    def __init__(self, items: int, k: int, kind: pa.DataType):
        self.k, self.least = k, np.ones(items, np.int64)
        self.held = [pa.table({"item": pa.array([], pa.int64()), "key": pa.array([], kind), "score": pa.array([], pa.int64())})]
        self.limit = max(100_000, 2 * k * items)

    def add(self, scores: np.ndarray, keys: pa.Array) -> None:
        doc, item = np.nonzero(scores >= self.least)
        self.held.append(pa.table({"item": pa.array(item), "key": keys.take(pa.array(doc)), "score": pa.array(scores[doc, item])}))
        if sum(t.num_rows for t in self.held) > self.limit:
            self.cut()

    def cut(self) -> pa.Table:
        rows = pa.concat_tables(self.held).combine_chunks()
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("item", "ascending"), ("score", "descending"), ("key", "ascending")]))
        item = rows.column("item").to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = np.flatnonzero(place == self.k - 1)
        self.least[item[last]] = rows.column("score").to_numpy()[last]
        rows = rows.filter(pa.array(place < self.k))
        self.held = [rows]
        return rows


def _best(counted: DataFrame, words: Vocabulary, weights: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """``item, key, score``: the ``k`` best documents of every item that each task has seen."""
    shared = counted.sparkSession.sparkContext.broadcast((words.first, words.holders, weights, len(words.items)))

    def run(batches):
        first, holders, weights, items = shared.value
        fan = np.diff(first)
        best = None
        for batch in batches:
            keys = batch.column("key")
            best = best or _Best(items, k, keys.type)
            lists = batch.column("terms")
            term = lists.flatten().to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            tf = batch.column("tfs").flatten().to_numpy()
            telling = weights[term] > 0
            term, doc, tf = term[telling], doc[telling], tf[telling]
            m = length_factor(batch.column("n").to_numpy(), documents, length)
            part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + SATURATION * m[doc]))
            entries = np.concatenate([[0], np.cumsum(fan[term])])
            starts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            at = 0
            while at < batch.num_rows:  # as many documents as fit, one at least
                to = int(np.searchsorted(entries[starts], entries[starts[at]] + ENTRIES, "right")) - 1
                to = max(at + 1, min(to, at + max(1, CELLS // items), batch.num_rows))
                here = slice(starts[at], starts[to])
                each = fan[term[here]]
                where = np.repeat(first[term[here]] - (np.cumsum(each) - each), each) + np.arange(each.sum())
                cells = np.repeat(doc[here] - at, each) * items + holders[where]
                scores = np.zeros((to - at) * items, np.int64)
                np.add.at(scores, cells, np.repeat(part[here], each))
                best.add(scores.reshape(to - at, items), keys.slice(at, to - at))
                at = to
        if best is not None:
            yield from best.cut().combine_chunks().to_batches()

    kind = counted.schema["key"].dataType.simpleString()
    return counted.mapInArrow(run, f"item bigint, key {kind}, score bigint")


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text",
                   item: str = "item_id", item_text: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The ``k`` best documents of every item, by the summed weights of the item's terms in them:
    ``item, rank, key, score``, scores above 0, best first, ties to the smaller key.

    A null text has no terms. Every row of ``docs`` is a document, also one that repeats another or has no
    key (it comes after others of its score). Rows with the same item id are one item; those without are
    left out. Items whose terms take more than ``slice_bytes`` together are dealt to several automata, each with a pass of
    its own; what one holds is bounded by that and the largest item. Empty tables give no rows.
    """
    spark = docs.sparkSession
    pairs = staged(items.filter(F.col(item).isNotNull()).select(
        F.col(item).alias("item"), F.explode(terms_of(F.col(item_text))).alias("term")).distinct(), "item-terms")
    size = pairs.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    slices = math.ceil(size / slice_bytes)
    kinds = f"`{item}` {pairs.schema['item'].dataType.simpleString()}"
    found, statistics = [], None
    for number in range(slices):
        mine = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(slices)) == number).orderBy("item", "term")
        words = Vocabulary.of([tuple(r) for r in mine.collect()])
        if not words.terms:
            continue
        counted = staged(_counted(docs, key, text, words.terms), "term-counts")
        if statistics is None:
            statistics = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        if not statistics[0]:
            break
        holding = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(words.terms), np.int64)  # a term in no document never counts
        for term, documents in holding:
            weights[term] = term_weight(statistics[0], documents)
        # A task sends k documents an item at most; two steps bound what one task of the ranking gets.
        sent = _best(counted, words, weights, *statistics, k).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        names = spark.createDataFrame(list(enumerate(words.items)), f"item bigint, {kinds}")
        found.append(_first(_first(sent, ["item", "salt"], k), ["item"], k).join(F.broadcast(names), "item")
                     .select(item, "rank", F.col("key").alias(key), "score"))
    if not found:
        return spark.createDataFrame([], f"{kinds}, rank int, `{key}` {docs.schema[key].dataType.simpleString()}, score bigint")
    return reduce(DataFrame.union, found)
