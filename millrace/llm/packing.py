"""Packing along a space-filling curve: documents that are alike end up in the same sequences.

A document becomes a hashed word vector, projected to a few dimensions; its place on a Hilbert curve
through that space is its sort key. Documents are sorted by ranges of the key, and every range is cut into
sequences along the curve, so a sequence holds neighbours and only the last one of a range is padded.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import ALNUM, chunks

DIMENSIONS, BITS = 4, 12
SEQUENCE = 1024
# Text of a range: so much that the padding of its last sequence does not matter.
RANGE_BYTES = 16 << 20
_EOS = 0


@lru_cache(maxsize=2)
def _rank_encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _definition(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _special_strings(path: str) -> tuple[str, ...]:
    return tuple(t.content for t in _definition(path).get_added_tokens_decoder().values())


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer points (rows) with ``bits`` bits a coordinate.

    Transposed Gray-code form: undo the excess rotations from the top bit down, then decode."""
    x = points.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(len(x)):
            high = (x[i] & q) > 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> np.uint64(b)) & one > 0, turn ^ np.uint64((1 << b) - 1), turn)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(len(x)):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key.view(np.int64)


def projections(column: pa.Array, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Each text's bag of hashed words on a few random axes: word hashes give the axis signs, every
    coordinate is divided by the root of the word count. Empty texts lie at the origin."""
    parts = []
    for chunk in chunks(column):
        starts, ends, bounds = chunk.words(ALNUM)
        hashes = chunk.hashes(starts, ends)
        counts = np.diff(bounds)
        rows = np.zeros((len(counts), dimensions))
        for d in range(dimensions):
            sign = ((hashes >> np.uint64(7 * d + 3)) & np.uint64(1)).astype(np.float64) * 2 - 1
            sums = np.concatenate([[0.0], np.cumsum(sign)])
            rows[:, d] = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.sqrt(np.maximum(counts, 1))
        parts.append(rows)
    return np.concatenate(parts) if parts else np.zeros((0, dimensions))


def _grid(points: np.ndarray) -> np.ndarray:
    """Coordinates as integers; the scale is fixed, so a key depends on its text alone."""
    return np.clip((np.tanh(points / 8) + 1) * 2 ** (BITS - 1), 0, 2**BITS - 1).astype(np.int64)


def on_curve(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text`` of every row and ``curve``, its place on the curve."""
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            curve = hilbert_key(_grid(projections(batch.column(1))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(curve, pa.int64())], [key, "text", "curve"])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, text string, curve bigint")


@dataclass(frozen=True)
class Encoder:
    """Token ids of a text. ``tokenizer`` defines them; ``ranks`` is the same vocabulary as a rank file,
    for an encoder several times as fast, and ``pattern`` its splitting rule. A text that holds the string
    of a special token, which only the former treats as one, goes to the former."""

    tokenizer: str
    ranks: str
    pattern: str

    def ids(self, text: str) -> list[int]:
        if "<|" in text and any(m in text for m in _special_strings(self.tokenizer)):
            return _definition(self.tokenizer).encode(text, add_special_tokens=False).ids
        return _rank_encoder(self.ranks, self.pattern).encode_ordinary(text)


def pack(docs: DataFrame, encoder: Encoder, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE,
         range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Pieces of documents: ``key, start, length, ids, doc_tokens, sequence_id, offset``.

    A document is its token ids and a closing id 0; null and empty texts are the closing id alone.
    Documents are laid end to end along the curve, ties by hash of the key, key and text, and cut
    wherever a sequence is full: every id lies in exactly one piece, and a sequence is gapless.
    ``ids`` holds little-endian unsigned 32-bit integers. Only the last sequence of a range of about
    ``range_bytes`` of text is padded. Repeated rows are packed each; an empty table gives no pieces.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(text)) + 1)).first()[0] or 0
    order = ["curve", F.xxhash64(key), key, F.xxhash64("text")]
    ordered = (on_curve(docs, key, text).repartitionByRange(max(1, -(-total // range_bytes)), *order)
               .sortWithinPartitions(*order).select(key, "text", F.spark_partition_id().alias("range")))
    fields = ("start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")

    def cut(batches):
        offset, number = 0, 0
        # a few hundred texts at a time: their ids take several times the space of the text
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            out: list[list] = [[] for _ in range(7)]
            keys = []
            for row, (value, part) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                ids = np.array([*encoder.ids(value or ""), _EOS], "<u4")
                at = 0
                while at < len(ids):
                    if offset == sequence:
                        offset, number = 0, number + 1
                    length = min(len(ids) - at, sequence - offset)
                    keys.append(row)
                    # The range's number and the number within it; 2**32 sequences to a range are out of reach.
                    piece = (at, length, ids[at:at + length].tobytes(), len(ids), (part << 32) + number, offset)
                    for column, v in zip(out, piece):
                        column.append(v)
                    at, offset = at + length, offset + length
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keys, pa.int64())), *[pa.array(c, k) for c, k in zip(out, kinds)]],
                [key, *[f.split()[0] for f in fields.split(", ")]])

    return ordered.mapInArrow(cut, f"`{key}` {ordered.schema[key].dataType.simpleString()}, {fields}")


def report(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    return pieces.select(key, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
