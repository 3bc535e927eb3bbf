"""Toxicity: a factorization machine over hashed terms.

Every term has a weight and a short vector; a text's logit is the sum of its terms' weights and of
the products of all pairs of their vectors, so two terms can matter together that do not alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import ALNUM, chunks, mix, over_texts

BUCKETS = 1 << 20
PREFIX = 5
BLOCK = 2048  # texts learnt from at once


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(terms, bounds): the distinct hashed terms of each text, words in lower case and the first
    ``PREFIX`` bytes of longer ones, which inflected and compound forms share."""
    found, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for chunk in chunks(column):
        starts, ends, bounds = chunk.words(ALNUM)
        texts = len(bounds) - 1
        text_of = np.repeat(np.arange(texts), np.diff(bounds))
        longer = ends - starts > PREFIX
        whole = chunk.hashes(starts, ends)
        stem = mix(chunk.hashes(starts[longer], starts[longer] + PREFIX) + np.uint64(1))
        hashes = np.concatenate([whole, stem]) % np.uint64(BUCKETS)
        key = np.unique(np.concatenate([text_of, text_of[longer]]).astype(np.int64) * BUCKETS + hashes.astype(np.int64))
        found.append((key % BUCKETS).astype(np.int32))
        sizes.append(np.bincount(key // BUCKETS, minlength=texts))
    return np.concatenate(found), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


@dataclass(frozen=True)
class Machine:
    """``place`` maps a term to its row of ``weight`` and ``factors``; -1 for terms without one."""

    bias: float
    place: np.ndarray
    weight: np.ndarray
    factors: np.ndarray

    def logit(self, found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        row = self.place[found]
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[row >= 0]
        return _logit(row[row >= 0], text, len(bounds) - 1, self.bias, self.weight, self.factors)

    def score(self, found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(found, bounds), -60, 60)))


def _logit(row, text, texts, bias, weight, factors) -> np.ndarray:
    out = bias + np.bincount(text, weights=weight[row], minlength=texts)
    for f in range(factors.shape[1]):
        v = factors[row, f]
        out += 0.5 * (np.bincount(text, weights=v, minlength=texts) ** 2 - np.bincount(text, weights=v * v, minlength=texts))
    return out


def _spread(seen: np.ndarray, with_one: np.ndarray, share: float, evidence: float, support: float) -> np.ndarray:
    """How far a term's weight and vector may move, 0 to 1: the more, the clearer the term tells the labels apart by
    itself (chi-square with continuity correction against ``evidence``) or the more texts hold it (against
    ``support``), as one that only matters beside others shows nothing by itself."""
    expected = seen * share
    apart = np.maximum(np.abs(with_one - expected) - 0.5, 0)
    chi = np.maximum(apart**2 / np.maximum(expected * (1 - share), 1e-9) - 1, 0)
    return np.maximum(chi / (chi + evidence), seen / (seen + support))


def _losses(logit: np.ndarray, label: np.ndarray, cost: np.ndarray) -> float:
    return float((cost * np.logaddexp(0, np.where(label > 0, -logit, logit))).mean()) if len(label) else 0.0


def learn(found: np.ndarray, bounds: np.ndarray, label: np.ndarray, factors: int = 4, steps: int = 120,
          rate: float = 0.05, decay: float = 1e-4, evidence: float = 20.0, support: float = 2000.0, missed: float = 3.0,
          patience: int = 30, seed: int = 7) -> Machine:
    """A machine for all terms of the given texts, fitted by gradient steps. Every term learns at a scale of
    its own (``_spread``). A missed text of label 1 costs ``missed`` times one of label 0. Steps end
    when the loss over every fifth text, held back for that, has not fallen for ``patience`` of them; then all texts are
    learnt from for as many steps as were best. Without both labels it scores every text alike."""
    texts = len(label)
    share = (label.sum() + 1) / (texts + 2)
    place = np.full(BUCKETS, -1, np.int32)
    if label.min(initial=1) == label.max(initial=0) or not len(found):
        return Machine(float(np.log(share / (1 - share))), place, np.zeros(0), np.zeros((0, factors)))
    sizes = np.diff(bounds)
    kept, row, seen = np.unique(found, return_inverse=True, return_counts=True)
    with_one = np.bincount(row, weights=np.repeat(label, sizes), minlength=len(kept))
    place[kept] = np.arange(len(kept))
    scale = _spread(seen, with_one, label.mean(), evidence, support)
    cost = np.where(label > 0, missed, 1.0)
    row = row.astype(np.int32)

    def descend(taught: np.ndarray, most: int, watched: np.ndarray | None = None) -> tuple[int, Machine]:
        bias = float(np.log(share / (1 - share)))
        rng = np.random.default_rng(seed)
        weight, vectors = np.zeros(len(kept)), rng.normal(0, 0.05, (len(kept), factors))
        memory: dict[str, list] = {}
        best, best_at = np.inf, 1
        teaches = taught.astype(float) / taught.sum()

        def adam(name, value, grad, t):
            m, v = memory.setdefault(name, [np.zeros_like(grad), np.zeros_like(grad)])
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            return value - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)

        for t in range(1, most + 1):
            own, own_vectors = weight * scale, vectors * scale[:, None]
            grad_w, grad_v, grad_b = np.zeros(len(kept)), np.zeros_like(vectors), 0.0
            logits = np.empty(texts)
            # a block of texts at a time, so temporaries stay small
            for first in range(0, texts, BLOCK):
                last = min(first + BLOCK, texts)
                r = row[bounds[first]:bounds[last]]
                text = np.repeat(np.arange(last - first), sizes[first:last])
                logit = np.full(last - first, bias) + np.bincount(text, weights=own[r], minlength=last - first)
                held = []
                for f in range(factors):
                    v = own_vectors[r, f]
                    total = np.bincount(text, weights=v, minlength=last - first)
                    logit += 0.5 * (total**2 - np.bincount(text, weights=v * v, minlength=last - first))
                    held.append((v, total))
                logits[first:last] = logit
                error = ((1 / (1 + np.exp(-np.clip(logit, -60, 60))) - label[first:last])
                         * cost[first:last] * teaches[first:last])
                grad_b += error.sum()
                of = error[text]
                grad_w += np.bincount(r, weights=of, minlength=len(kept))
                for f, (v, total) in enumerate(held):
                    grad_v[:, f] += np.bincount(r, weights=of * (total[text] - v), minlength=len(kept))
            if watched is not None:
                loss = _losses(logits[watched], label[watched], cost[watched])
                if loss < best:
                    best, best_at = loss, t
                elif t - best_at >= patience:
                    break
            bias = float(adam("bias", bias, np.array(grad_b), t))
            weight = adam("weight", weight, grad_w * scale + decay * weight, t)
            vectors = adam("vectors", vectors, grad_v * scale[:, None] + 10 * decay * vectors, t)
        return best_at, Machine(bias, place, weight * scale, vectors * scale[:, None])

    watched = np.arange(texts) % 5 == 4
    length = steps
    if watched.any() and label[watched].max() > label[watched].min():
        length, _ = descend(~watched, steps, watched)
    return descend(np.ones(texts, bool), length)[1]


def fit(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text",
        sample: int = 16_384, **settings) -> Machine:
    """Learn from at most ``sample`` labelled documents, those with the smallest hash of their key: the
    bound of what the driver holds: of documents that share a key one teaches, the one with the smallest hash of
    its text. Labels other than 0 and 1, null keys and null texts teach nothing."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        key, F.col(label).cast("int").alias("label")).distinct()
    drawn = known.orderBy(F.xxhash64(key), key, "label").limit(sample)
    texts = docs.filter(F.col(text).isNotNull()).select(key, F.col(text).alias("text")).join(F.broadcast(drawn), key)
    texts = texts.groupBy(key, "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def work(column: pa.Array) -> list:
        found, bounds = terms(column)
        return [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(found))]

    marked = texts.select(F.struct(key, "label").alias("who"), "text")
    rows = over_texts(marked, "who", "text", "terms array<int>", work).select(
        F.col(f"who.{key}").alias("k"), "who.label", "terms").orderBy("k", "label").toArrow()
    column = rows.column("terms").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    found = column.flatten().to_numpy()
    bounds = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]) if len(column) else np.zeros(1, int)
    return learn(found, bounds, rows.column("label").to_numpy().astype(float), **settings)


def score(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` of every row; a null or empty text has no terms and gets the base rate's score."""
    return over_texts(docs, key, text, "score double", lambda column: [pa.array(machine.score(*terms(column)))])
