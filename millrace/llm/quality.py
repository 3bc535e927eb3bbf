"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each class has a mean and a covariance of transformed statistics, shrunk towards the pooled covariance
and its diagonal. A text's score is the logistic function of the difference of the two classes' log
densities, Mahalanobis distances taken with the Cholesky factors found once when fitting.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import VISIBLE, _BYTES, chunks, modest_batches, over_texts

_LETTERS = ((_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122), _BYTES >= 128)
# Bytes counted against the number of words, by class.
_CLASSES = (*_LETTERS, (_BYTES >= 48) & (_BYTES <= 57), np.isin(_BYTES, list(b".,;:?")), _BYTES == 33,
            np.isin(_BYTES, list(b"#$%&*@^~")), np.isin(_BYTES, list(b"|<>{}[]\\")), _BYTES == 10)
FEATURES = len(_CLASSES) + 8
_PAIRS = [(i, j) for i in range(FEATURES) for j in range(i, FEATURES)]
_FLOOR = 0.02


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` transformed statistics per text; an empty text has those of no words."""
    parts = [np.zeros((0, FEATURES))]
    for chunk in chunks(column, lower=False):
        starts, ends, bounds = chunk.words(VISIBLE)
        texts = len(bounds) - 1
        words = np.diff(bounds)
        per = 1 / np.maximum(words, 1)
        size = np.diff(chunk.bounds)

        def total(values: np.ndarray, at: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[at[1:]] - sums[at[:-1]]

        text_of = np.repeat(np.arange(texts), words)
        hashes = chunk.hashes(starts, ends)
        length = np.log((ends - starts).astype(np.float64))
        mean = total(length, bounds) * per
        again = np.zeros(len(hashes))
        again[1:] = (hashes[1:] == hashes[:-1]) & (text_of[1:] == text_of[:-1])
        order = np.lexsort((hashes, text_of))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text_of[order][1:] != text_of[order][:-1])
        at = np.flatnonzero(new)
        often = np.zeros(texts)
        np.maximum.at(often, text_of[order][at], np.diff(np.append(at, len(order))))
        kinds = np.bincount(text_of[order][at], minlength=texts)
        rows = [np.log(_FLOOR + total(kind[chunk.data], chunk.bounds) * per) for kind in _CLASSES]
        rows += [np.log1p(words), np.log1p(size) - np.log1p(words), mean,
                 np.sqrt(np.maximum(total(length**2, bounds) * per - mean**2, 0)),
                 np.log(_FLOOR + total(again, bounds) * per), np.log(_FLOOR + often * per),
                 np.log(_FLOOR + kinds * per), np.log(_FLOOR + total(chunk.data[starts] < 97, bounds) * per)]
        parts.append(np.stack(rows, axis=1))
    return np.concatenate(parts)


@dataclass(frozen=True)
class Gaussian:
    mean: np.ndarray
    factor: np.ndarray  # inverse of the covariance's lower Cholesky factor
    log_scale: float    # half the log determinant

    @classmethod
    def of(cls, mean: np.ndarray, covariance: np.ndarray) -> Gaussian:
        lower = np.linalg.cholesky(covariance)
        return cls(mean, np.linalg.inv(lower), float(np.log(np.diag(lower)).sum()))

    def log_density(self, rows: np.ndarray) -> np.ndarray:
        z = (rows - self.mean) @ self.factor.T
        return -0.5 * (z * z).sum(axis=1) - self.log_scale


@dataclass(frozen=True)
class Discriminant:
    """``classes`` is empty where the labels do not hold two rows of either class; every score is then
    the share of label 1 (a half without labels)."""

    classes: tuple[Gaussian, ...]
    log_prior: float
    temper: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        margin = np.full(len(rows), self.log_prior)
        if self.classes and len(rows):
            bad, good = self.classes
            margin = margin + self.temper * (good.log_density(rows) - bad.log_density(rows))
        return 1 / (1 + np.exp(-np.clip(margin, -60, 60)))


def discriminant(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = 0.1,
                 diagonal: float = 0.05, temper: float = 0.5) -> Discriminant:
    """From each class's (rows, sums, sums of products). ``pooled`` is the weight of the common covariance,
    ``diagonal`` that of its diagonal; ``temper`` scales the difference of the log densities, which count
    dependent statistics as if they were independent evidence."""
    n = [moments[c][0] if c in moments else 0.0 for c in (0, 1)]
    log_prior = float(np.log((n[1] + 1) / (n[0] + 1)))
    if min(n) < 2:
        return Discriminant((), log_prior, temper)
    means = [moments[c][1] / n[c] for c in (0, 1)]
    own = [moments[c][2] / n[c] - np.outer(m, m) for c, m in zip((0, 1), means)]
    common = (n[0] * own[0] + n[1] * own[1]) / sum(n)
    ground = np.diag(np.diag(common) + 1e-3)
    return Discriminant(tuple(Gaussian.of(m, (1 - pooled - diagonal) * s + pooled * common + diagonal * ground)
                              for m, s in zip(means, own)), log_prior, temper)


def class_moments(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``label, rows, sums, products`` of each class: sums of the statistics, and of their products in pairs
    (i, j), i <= j. Only the statistics need Python; they are summed in the JVM, so a task has one worker."""
    modest_batches(docs.sparkSession)
    stats = over_texts(docs, key, text, "stats array<double>", lambda column: [_lists(statistics(column))])
    known = stats.join(labels.filter(F.col(label).isin(0, 1)).select(key, F.col(label).cast("int").alias("label")), key)
    one = [F.col("stats")[i] for i in range(FEATURES)]
    return known.groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"), F.array(*[F.sum(x) for x in one]).alias("sums"),
        F.array(*[F.sum(one[i] * one[j]) for i, j in _PAIRS]).alias("products"))


def fit(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text") -> Discriminant:
    """The discriminant of all labelled documents. ``labels``: one ``key`` and ``label`` (0 or 1) each; other
    and null labels are left out. The driver gets one number for each pair of statistics."""
    moments = {}
    for row in class_moments(docs, labels, label, key, text).collect():
        products = np.zeros((FEATURES, FEATURES))
        for (i, j), value in zip(_PAIRS, row["products"]):
            products[i, j] = products[j, i] = value
        moments[row["label"]] = (float(row["rows"]), np.array(row["sums"]), products)
    return discriminant(moments)


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * FEATURES
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def score(docs: DataFrame, model: Discriminant, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` of every row; null and empty texts are scored as texts without words."""
    return over_texts(docs, key, text, "score double", lambda column: [pa.array(model.score(statistics(column)))])


def accepted(docs: DataFrame, model: Discriminant, threshold: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, all columns kept."""
    modest_batches(docs.sparkSession)

    # only the texts go to the worker, and a flag comes back
    @F.arrow_udf("boolean")
    def accepts(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(statistics(texts)) >= threshold)

    return docs.filter(accepts(F.col(text)))


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether a row is kept from learning: CRC-32 of the key's text divisible by ``folds``."""
    return F.crc32(key.cast("string").cast("binary")) % folds == 0
