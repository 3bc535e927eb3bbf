"""Words and word hashes of many texts at once, on UTF-8 bytes.

Arrow hands a task its texts as one buffer, so a task works on chunks of whole texts with a few
array operations instead of a Python loop over words. Only A-Z is lower-cased; all bytes of a
character outside ASCII are alike, so rules over ASCII characters can be applied to bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

CHUNK_BYTES = 1 << 20

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
# Words of letters, digits and everything outside ASCII (after lower-casing).
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
# Words between white space (blank, tab, line ends).
VISIBLE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256).astype(np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and doubled as longer chunks come."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, np.uint64)
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
    _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


@dataclass
class Chunk:
    """Whole texts laid end to end: rows ``first`` .. ``first + len(bounds) - 2`` of the batch."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def words(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, word bounds per text) of the maximal runs of ``kind`` bytes."""
        inside = kind[self.data]
        before = np.zeros(len(inside) + 1, bool)
        before[1:] = inside
        after = np.zeros(len(inside) + 1, bool)
        after[:-1] = inside
        before[self.bounds] = False
        after[self.bounds] = False
        starts = np.flatnonzero(inside & ~before[:-1])
        ends = np.flatnonzero(inside & ~after[1:]) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of every word, the same in every process."""
        n = len(self.data) + 1
        sums = np.zeros(n, np.uint64)
        np.cumsum(_VALUE[self.data] * _power_table(_BASE, n)[:-1], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * _power_table(_INVERSE, n)[starts])


def hash_of(word: bytes) -> np.uint64:
    data = LOWER[np.frombuffer(word, np.uint8)]
    chunk = Chunk(0, data, np.array([0, len(data)]))
    return chunk.hashes(np.array([0]), np.array([len(data)]))[0]


def utf8(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary())


def chunks(column: pa.Array, lower: bool = True, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Chunks of about ``limit`` bytes over a string column; a null text is an empty one. A text
    longer than that is a chunk of its own."""
    column = utf8(column.fill_null("") if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
                  else column)
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        part = data[offsets[at]:offsets[to]]
        yield Chunk(at, LOWER[part] if lower else part, offsets[at:to + 1] - offsets[at])
        at = to


def ngrams(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``n`` consecutive words; a text with fewer words, but not none,
    gives its whole sequence as one."""
    counts = np.diff(bounds)
    grams = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), grams)
    local = np.arange(len(text)) - np.repeat(np.cumsum(grams) - grams, grams)
    at = bounds[:-1][text] + local
    length = np.minimum(counts, n)[text]
    out = mix(length.astype(np.uint64))
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    for i in range(n):
        out = np.where(i < length, mix(out * np.uint64(0x9FB21C651E98DF25) + padded[at + i]), out)
    return out, text


BATCH_BYTES = 1 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def modest_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_BYTES`` from now on, unless the session names a bound of its own: a batch exists several
    times over in the JVM, the socket and the worker, beside whatever else the stage holds. Buffers double as they fill, so
    larger batches outgrow the chunks of 4 MB in which the JVM keeps and reuses Arrow memory."""
    if spark.conf.get(_BATCHES).rstrip("b") == str(64 << 20):
        spark.conf.set(_BATCHES, str(BATCH_BYTES))


def over_texts(docs: DataFrame, key: str, text: str, outputs: str,
               work: Callable[[pa.Array], list]) -> DataFrame:
    """``key`` and the columns ``outputs`` (DDL) that ``work`` makes of a batch's texts, one value
    for each text. Only the two named columns are read; a null text stays null for ``work``."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    made = _parse_datatype_string(outputs)
    schema = StructType([StructField(key, rows.schema[0].dataType), *made.fields])
    names = [f.name for f in schema.fields]

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *work(batch.column(1))], names)

    return rows.mapInArrow(run, schema)
