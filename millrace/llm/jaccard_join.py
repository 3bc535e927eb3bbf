"""Similarity join of documents on word shingles, exact, by a partitioned universe.

Two sets with Jaccard similarity of at least t differ in at most H elements, H following from
their sizes. Elements are hashed into more than H segments (their number depends on the size band),
so of the segments that are not empty at least one is alike in both sets.

* Every set posts a signature of each of its segments. In bands where some set fills too few
  segments, segments of two or more elements also post their one-deletion neighbourhood, and then
  count twice: without a match there they differ in two elements at least. A set that even so fills too few
  is compared with all others by counting common elements.
* A set whose segments without any match already prove more than H differences has no partner.
  Most sets end here; only the others are read again.
* Each of these is first compared with a few sets that share many of its smallest signatures, which similar sets
  have mostly in common. What is linked this way needs no further comparison with its own group, so large
  groups of copies cost a few pairs a set. This only saves work: what it misses, the next step finds.
* Between groups, a set looks up its cheapest segments (those with the fewest postings) until the
  differences proved by all others and these exceed H. What it finds are groups, not their members, less those whose
  parity sketches all differ from its own at more than H places, by the distance to one member and the group's radius.
  Then its sketch is compared with each member's; the nearest few are verified on whole sets, and the others left
  within H places only where these did not link the set to the group.

Sets are kept as 64-bit hashes of shingles, and documents with equal sets as one set with a 64-bit
fingerprint.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.bytewords import BATCH_BYTES, VISIBLE, chunks, mix, modest_batches, ngrams
from millrace.llm.components import components
from millrace.session import staged

BROADCAST_ROWS = 1_000_000  # rows of two or three numbers
ENTRIES = 400_000           # postings a task sorts at once
FLUSH_BYTES = 8 << 20       # text whose postings a task holds before passing them on
ROW_POSTINGS = 8192         # postings in a row, 13 bytes each
BATCH_ROWS = 65_536         # short rows in an Arrow batch that a task gives back
POSTED = 500_000            # sets a task remembers to have posted
STAR_ROUNDS, STAR_PAIRS = 2, 6
PROBES = 32                 # smallest signatures of a set at each level, by which groups are formed first
SKETCH = 1024               # bits of a sketch
SLICE = 512                 # members of a group whose sketches are compared under one key
SALT = 0
OWN, LOW = 0, 1             # a set in the scheme of its own size band, and of the band below
_SEED = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Bands:
    """Size bands for a threshold of ``percent``: partners lie in the same or the next band."""

    percent: int
    edges: tuple[int, ...]

    @classmethod
    def up_to(cls, largest: int, percent: int) -> Bands:
        edges = [1]
        while edges[-1] <= largest:
            edges.append(edges[-1] * 100 // percent + 1)
        return cls(percent, tuple(edges))

    def band(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, sizes, "right") - 1

    def segments(self) -> np.ndarray:
        """Segments by band: enough that a set fills more of them than it may differ in."""
        room = 100 / self.percent - 1
        return np.array([ceil(1.12 * room * (e - 1) + 1.5 * sqrt(e - 1) + 4) for e in self.edges[1:]], np.uint64)


def shingle_sets(hashes: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(elements, owner, sizes) of the distinct shingles of each text, by owner and element."""
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], text[new], np.bincount(text[new], minlength=texts)


def sets_of(column: pa.Array, words: int):
    """(first row, elements, owner, sizes) for chunks of texts."""
    for chunk in chunks(column):
        starts, ends, bounds = chunk.words(VISIBLE)
        grams, text = ngrams(chunk.hashes(starts, ends), bounds, words)
        yield chunk.first, *shingle_sets(grams, text, len(bounds) - 1)


def nodes_of(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each set, whatever the order of its elements."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(elements + _SEED), dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return mix(sums[ends] - sums[ends - sizes] + mix(sizes.astype(np.uint64))).view(np.int64)


@dataclass(frozen=True)
class Scheme:
    bands: Bands
    salt: int
    deleting: frozenset[int] = frozenset()

    def split(self, elements: np.ndarray, owner: np.ndarray, sizes: np.ndarray, level: int):
        """Segments of the sets at a level: (owner, segment, band, sum of the elements' hashes, number of elements,
        order of the elements by segment, their hashes in that order)."""
        band = self.bands.band(sizes) - level
        kept = (band >= 0)[owner]
        elements, owner = elements[kept], owner[kept]
        of = band[owner]
        key = mix(elements ^ (mix(np.uint64(self.salt) + of.astype(np.uint64) * _SEED)))
        segment = (key % self.bands.segments()[of] if len(of) else key).astype(np.int64)
        order = np.lexsort((segment, owner))
        owner, segment, value = owner[order], segment[order], mix(elements[order] * np.uint64(3))
        first = np.ones(len(owner), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (segment[1:] != segment[:-1])
        at = np.flatnonzero(first)
        total = np.add.reduceat(value, at) if len(at) else value
        return owner[at], segment[at], band[owner[at]], total, np.diff(np.append(at, len(owner))), value

    def sizes_filled(self, elements, owner, sizes, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(segments filled, those with two or more elements) of every set."""
        own, _, _, _, number, _ = self.split(elements, owner, sizes, level)
        return np.bincount(own, minlength=len(sizes)), np.bincount(own[number > 1], minlength=len(sizes))

    def postings(self, elements, owner, sizes, level: int):
        """(owner, segment, signature, weight, whether a deletion) of every posting at a level."""
        own, segment, band, total, number, value = self.split(elements, owner, sizes, level)
        place = mix(band.astype(np.uint64) * np.uint64(1 << 32) + segment.astype(np.uint64) + np.uint64(self.salt))
        twice = np.isin(band, sorted(self.deleting)) & (number > 1)
        weight = 1 + twice.astype(np.int8)
        parts = [(own, segment, mix(total + place), weight, np.zeros(len(own), bool))]
        if twice.any():
            each = np.repeat(np.arange(len(own)), number)
            each, value = each[twice[each]], value[twice[each]]
            parts.append((own[each], segment[each], mix(total[each] - value + place[each]), weight[each],
                          np.ones(len(each), bool)))
        return [np.concatenate(x) for x in zip(*parts)]


def parity_sketches(elements: np.ndarray, owner: np.ndarray, sets: int) -> np.ndarray:
    """``SKETCH`` bits for each set, as 64-bit words: whether an odd number of elements hash to a place. Two
    sketches differ at no more places than the sets do in elements."""
    place = owner * SKETCH + (mix(elements + np.uint64(5)) % np.uint64(SKETCH)).astype(np.int64)
    odd = np.bincount(place, minlength=sets * SKETCH).reshape(sets, SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def _summaries(docs: DataFrame, scheme: Scheme, words: int) -> DataFrame:
    """``id, copy, node, n`` and the segments filled at both levels, for each document."""
    fields = "node bigint, n bigint, own bigint, own_many bigint, low bigint, low_many bigint"

    def run(batches):
        for batch in batches:
            parts = []
            for _, elements, owner, sizes in sets_of(batch.column("text"), words):
                filled = [x for level in (OWN, LOW) for x in scheme.sizes_filled(elements, owner, sizes, level)]
                parts.append([nodes_of(elements, sizes), sizes, *filled])
            made = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("copy"), *[pa.array(x.astype(np.int64)) for x in made]],
                ["id", "copy", *[f.split()[0] for f in fields.split(", ")]])

    return docs.mapInArrow(run, f"id bigint, copy bigint, {fields}")


def _allowed(bands: Bands) -> list[str]:
    """SQL: differences allowed at the two levels for a set of ``n`` elements, and its band."""
    edges = ", ".join(str(e) for e in bands.edges)
    below = f"array_max(filter(array({edges}), e -> e <= n)) - 1"
    part = f"{100 - bands.percent} * (n + {{}}) div {100 + bands.percent}"
    return [part.format(f"n * 100 div {bands.percent}") + " as own_most",
            part.format(f"least(n - 1, {below})") + " as low_most",
            f"cast(size(filter(array({edges}), e -> e <= n)) - 1 as int) as band"]


def _packed(held: list[tuple], shares: int):
    """Batches ``share, signature, node, code`` of the held postings. A batch is small enough to fit the chunks in
    which the JVM keeps Arrow memory; larger ones are allocated one by one, and executors do not give that back."""
    signature, node, code = (np.concatenate(x) for x in zip(*held))
    share = (signature % np.uint64(shares)).astype(np.int32)
    order = np.argsort(share, kind="stable")
    # Within a share 32 bits tell signatures apart well enough: a false match only costs a look.
    short = (signature[order] >> np.uint64(32)).astype(np.uint32)
    share, node, code = share[order], node[order], code[order]
    first = np.flatnonzero(np.append(True, share[1:] != share[:-1])[:len(share)])
    ends = np.append(first[1:], len(share))
    cuts = [(at, min(at + ROW_POSTINGS, end)) for begin, end in zip(first.tolist(), ends.tolist())
            for at in range(begin, end, ROW_POSTINGS)]
    cut = lambda x, some: pa.array([x[at:to].tobytes() for at, to in some], pa.binary())
    size, some = 0, []
    for i, (at, to) in enumerate(cuts):
        some.append((at, to))
        size += to - at
        if size > BATCH_BYTES // 26 or i == len(cuts) - 1:
            yield pa.RecordBatch.from_arrays(
                [pa.array(share[[at for at, _ in some]]), cut(short, some), cut(node, some), cut(code, some)],
                ["share", "signature", "node", "code"])
            size, some = 0, []


def _matched_weight(docs: DataFrame, scheme: Scheme, words: int, shares: int) -> DataFrame:
    """``node, level, matched``: weight of the segments of each set that match one of another set.

    Postings travel as packed arrays, rows of at most ``ROW_POSTINGS`` for a run of texts and a share of the
    signatures, and are sorted in the task that gets the share."""
    def post(batches):
        posted: set[int] = set()  # sets this task has posted: copies add nothing
        for batch in batches:
            held, size = [], 0
            for _, elements, owner, sizes in sets_of(batch.column("text"), words):
                node = nodes_of(elements, sizes)
                if len(posted) > POSTED:
                    posted.clear()
                fresh = np.zeros(len(node), bool)
                for i, x in enumerate(node.tolist()):
                    if x not in posted:
                        posted.add(x)
                        fresh[i] = True
                elements, owner = elements[fresh[owner]], (np.cumsum(fresh) - 1)[owner[fresh[owner]]]
                node, sizes = node[fresh], sizes[fresh]
                for level in (OWN, LOW):
                    own, _, signature, weight, deleted = scheme.postings(elements, owner, sizes, level)
                    held.append((signature, node[own], (weight - 1 + 2 * deleted + 4 * level).astype(np.uint8)))
                size += len(elements)
                if size * 8 > FLUSH_BYTES:
                    yield from _packed(held, shares)
                    held, size = [], 0
            if held:
                yield from _packed(held, shares)

    def match(group: pa.Table) -> pa.Table:
        joined = lambda name, kind: np.frombuffer(b"".join(group.column(name).to_pylist()), kind)
        signature, node, code = joined("signature", np.uint32), joined("node", np.int64), joined("code", np.uint8)
        order = np.lexsort((code, node, signature))
        signature, node, code = signature[order], node[order], code[order]
        # copies of one set post alike: each posting counts once
        new = np.ones(len(node), bool)
        new[1:] = (signature[1:] != signature[:-1]) | (node[1:] != node[:-1]) | (code[1:] != code[:-1])
        signature, node, code = signature[new], node[new], code[new]
        first = np.flatnonzero(np.append(True, signature[1:] != signature[:-1]))
        last = np.append(first[1:], len(signature)) - 1
        run = np.repeat(np.arange(len(first)), last - first + 1)
        lowest, highest = node[first], node[last]
        deleted = (code & 2) > 0
        top, bottom = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        low_whole = np.minimum.reduceat(np.where(deleted, top, node), first)
        high_whole = np.maximum.reduceat(np.where(deleted, bottom, node), first)
        other = np.where(deleted, (low_whole[run] < node) | (high_whole[run] > node),
                         (lowest[run] < node) | (highest[run] > node))
        node, code = node[other], code[other]
        found = []
        for level in (OWN, LOW):
            mine = (code >> 2) == level
            key, where = np.unique(node[mine], return_inverse=True)
            total = np.bincount(where, weights=(code[mine] & 1) + 1.0, minlength=len(key)).astype(np.int64)
            found.append((key, np.full(len(key), level, np.int32), total))
        key, level, total = (np.concatenate(x) for x in zip(*found))
        found = pa.table({"node": key, "level": level, "matched": total})
        return pa.Table.from_batches(found.to_batches(max_chunksize=BATCH_ROWS), found.schema)

    posted = docs.select("text").mapInArrow(post, "share int, signature binary, node binary, code binary")
    return (posted.groupBy("share").applyInArrow(match, "node bigint, level int, matched bigint")
            .groupBy("node", "level").agg(F.sum("matched").alias("matched")))


def _read_sets(docs: DataFrame, words: int) -> DataFrame:
    """``node, n, elements`` of documents."""
    def run(batches):
        for batch in batches:
            for _, elements, owner, sizes in sets_of(batch.column("text"), words):
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes_of(elements, sizes)), pa.array(sizes.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(elements.view(np.int64)))],
                    ["node", "n", "elements"])

    return docs.select("text").mapInArrow(run, "node bigint, n bigint, elements array<bigint>")


def _smallest(own: np.ndarray, signature: np.ndarray, deleted: np.ndarray) -> np.ndarray:
    """Marks the ``PROBES`` smallest signatures of whole segments of every set."""
    order = np.lexsort((signature, deleted, own))
    first = np.append(True, own[order][1:] != own[order][:-1])[:len(own)]
    place = np.arange(len(own)) - np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
    out = np.zeros(len(own), bool)
    out[order[place < PROBES]] = True
    return out & ~deleted


def _postings(sets: DataFrame, scheme: Scheme) -> DataFrame:
    """One row per posting of the sets read again, at the levels (``own``, ``low``) still open."""
    def run(batches):
        for batch in batches:
            column = batch.column("elements")
            elements = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = batch.column("n").to_numpy()
            owner = np.repeat(np.arange(len(sizes)), sizes)
            node = batch.column("node").to_numpy()
            for level, name in ((OWN, "own"), (LOW, "low")):
                open_ = batch.column(name).to_numpy(zero_copy_only=False)
                own, segment, signature, weight, deleted = scheme.postings(elements, owner, sizes, level)
                k = open_[own]
                made = pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (signature[k].view(np.int64), node[own[k]], sizes[own[k]],
                                           np.full(k.sum(), level, np.int32), segment[k], weight[k].astype(np.int32),
                                           deleted[k], _smallest(own, signature, deleted)[k])],
                    ["signature", "node", "n", "level", "segment", "weight", "deleted", "probe"])
                for at in range(0, made.num_rows, BATCH_ROWS // 2):
                    yield made.slice(at, BATCH_ROWS // 2)

    return sets.select("node", "n", "elements", "own", "low").mapInArrow(
        run, "signature bigint, node bigint, n bigint, level int, segment bigint, weight int, deleted boolean, probe boolean")


def _sketches(sets: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            column = batch.column("elements")
            sizes = batch.column("n").to_numpy()
            parts = [np.zeros((0, SKETCH // 64), np.int64)]
            ends = np.cumsum(sizes)
            elements = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(sizes), 1000):
                some = sizes[at:at + 1000]
                parts.append(parity_sketches(elements[ends[at] - sizes[at]:ends[at + len(some) - 1]],
                                             np.repeat(np.arange(len(some)), some), len(some)))
            rows = np.concatenate(parts)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))],
                ["node", "n", "sketch"])

    return sets.select("node", "n", "elements").mapInArrow(run, "node bigint, n bigint, sketch array<bigint>")


def _apart(x: str, y: str) -> Column:
    """Places at which two sketches differ."""
    return reduce(lambda a, b: a + b, [F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(SKETCH // 64)])


def _possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sketches do not prove that they differ too much, written."""
    side = lambda x: sketches.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"k_{x}"))
    return staged(pairs.join(side("a"), "a").join(side("b"), "b").filter(
        _apart("k_a", "k_b") * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)).select("a", "b"), "pairs")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the (written) pairs (a, b) whose whole sets are similar enough. Only sets of pairs travel."""
    sides = _small(pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node")))
    met = (sets.select("node", "elements").join(sides, "node").groupBy("a", "b")
           .agg(F.collect_list("elements").alias("e")))
    both = F.size(F.array_intersect(F.col("e")[0], F.col("e")[1]))
    every = F.size(F.col("e")[0]) + F.size(F.col("e")[1])
    return met.filter(both * 100 >= (every - both) * percent).select("a", "b")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _with_groups(postings: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Postings with the group their set belongs to so far; only signatures met in several groups."""
    if groups is None:
        marked = postings.withColumn("comp", F.col("node")).withColumn("members", F.lit(1).cast("bigint"))
    else:
        sizes = groups.groupBy("comp").agg((F.count(F.lit(1)) + 1).alias("members"))
        known = groups.select("node", "comp").union(groups.select(F.col("comp").alias("node"), "comp").distinct())
        known = _small(staged(known.join(sizes, "comp"), "groups"))
        marked = (postings.join(known, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
                  .withColumn("members", F.coalesce("members", F.lit(1).cast("bigint"))))
    mixed = (marked.groupBy("signature").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"),
                                             F.count(F.lit(1)).alias("cost"))
             .filter(F.col("_lo") < F.col("_hi")).select("signature", "cost"))
    return marked.join(mixed, "signature")


def _star_pairs(mixed: DataFrame, attempt: int) -> DataFrame:
    """For every set a few sets of other groups to compare with first. Every signature has one of its sets, drawn
    by hash, as leader; a set takes the leaders it shares most signatures with."""
    leader = mixed.groupBy("signature").agg(
        F.min(F.struct(F.xxhash64("signature", "node", F.lit(attempt)).alias("h"), "node", "comp")).alias("l"))
    led = (mixed.join(leader, "signature").filter(F.col("l.comp") != F.col("comp"))
           .groupBy("node", F.col("l.node").alias("leader")).agg(F.count(F.lit(1)).alias("shared")))
    order = Window.partitionBy("node").orderBy(F.desc("shared"), F.xxhash64("leader", F.lit(attempt)), "leader")
    best = led.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= STAR_PAIRS)
    return best.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _asks(mixed: DataFrame, open_sets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``x, comp, members``: the groups that hold one of the cheapest segments of a set ``x`` of another group, as many
    segments as are needed, unless sketches prove that all members differ too much. A group stands here once a signature,
    whatever its size: its members lie within a radius of one of them."""
    segments = (mixed.groupBy("node", "level", "segment").agg(F.sum("cost").alias("cost"), F.max("weight").alias("weight")))
    order = Window.partitionBy("node", "level").orderBy("cost", "segment")
    whole = Window.partitionBy("node", "level")
    limits = sets.select("node", F.explode(F.array(
        F.struct(F.lit(OWN).alias("level"), F.col("own_weight").alias("total"), F.col("own_most").alias("most")),
        F.struct(F.lit(LOW).alias("level"), F.col("low_weight").alias("total"), F.col("low_most").alias("most")))).alias("x")
                        ).select("node", "x.*")
    before = F.coalesce(F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = (segments.withColumn("before", before).withColumn("all", F.sum("weight").over(whole))
              .join(limits, ["node", "level"])
              .filter(F.col("total") - F.col("all") + F.col("before") <= F.col("most"))
              .select("node", "level", "segment"))
    center = (open_sets.groupBy("comp").agg(F.min("node").alias("node")).join(open_sets.select("node", "sketch"), "node")
              .select("comp", F.col("sketch").alias("center")))
    radius = (open_sets.join(center, "comp").groupBy("comp").agg(F.max(_apart("sketch", "center")).alias("radius")))
    # Narrow rows are matched with what was chosen; only then the sketches join.
    asking = mixed.join(chosen, ["node", "level", "segment"]).join(open_sets.select("node", "sketch"), "node").select(
        "signature", F.col("node").alias("x"), F.col("comp").alias("cx"), F.col("n").alias("nx"),
        F.col("deleted").alias("dx"), F.col("members").alias("mx"), F.col("sketch").alias("kx"))
    asked = (mixed.groupBy("signature", "comp").agg(
        F.min("deleted").alias("deleted"), F.max("members").alias("members"), F.min("n").alias("least"), F.max("n").alias("most"))
        .join(center.join(radius, "comp"), "comp"))
    # A pair across groups shows from either side: the member of the smaller group asks.
    fits = ((F.struct("mx", "cx") < F.struct("members", "comp")) & ~(F.col("dx") & F.col("deleted"))
            & (F.col("nx") * percent <= F.col("most") * 100) & (F.col("least") * percent <= F.col("nx") * 100)
            & ((_apart("kx", "center") - F.col("radius")) * (100 + percent) <= (F.col("nx") + F.col("most")) * (100 - percent)))
    return asking.join(asked, "signature").filter(fits & (F.col("cx") != F.col("comp"))).select("x", "comp", "members")


def _cross_pairs(mixed: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different groups that may be similar, each once, with their place (``nth``) among those of one set
    and one group, the nearest by sketch first. Large groups are compared a slice at a time."""
    known = mixed.groupBy("node").agg(F.first("comp").alias("comp"), F.first("members").alias("members"))
    open_sets = staged(sketches.join(known, "node"), "grouped-sketches")
    asks = staged(_asks(mixed, open_sets, sets, percent).distinct(), "asks")
    slices = F.ceil(F.col("members") / SLICE).cast("int")
    mine = asks.join(open_sets.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("sketch").alias("kx")), "x").select(
        "*", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    theirs = open_sets.select("comp", "node", "n", "sketch", F.pmod(F.xxhash64("node"), slices).cast("int").alias("slice"))
    fits = ((F.least("nx", "n") * 100 >= F.greatest("nx", "n") * percent)
            & (_apart("kx", "sketch") * (100 + percent) <= (F.col("nx") + F.col("n")) * (100 - percent)))
    near = staged(mine.join(theirs, ["comp", "slice"]).filter(fits).select(
        "x", "comp", "node", _apart("kx", "sketch").alias("apart")), "near")
    nth = F.row_number().over(Window.partitionBy("x", "comp").orderBy("apart", "node"))
    return near.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"), nth.alias("nth"))


def _between(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that ``groups`` leave in different groups."""
    side = lambda x: groups.select(F.col("node").alias(x), F.col("comp").alias(f"c_{x}"))
    named = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return named.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def _links_of(unproven: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame | None:
    """Links (a, b) of the given sets with any others, by counting common elements; None without such sets. All
    texts are read again, and only their elements that one of these sets holds go on."""
    if unproven.isEmpty():
        return None
    wanted = _small(unproven.select(F.col("rep.id").alias("_i"), F.col("rep.copy").alias("_c")))
    own = rows.join(wanted, F.col("id").eqNullSafe(F.col("_i")) & (F.col("copy") == F.col("_c")), "left_semi")
    held = staged(_read_sets(own, words).dropDuplicates(["node"])
                  .select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.explode("elements").alias("element")), "unproven-elements")
    every = _read_sets(rows, words).select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.explode("elements").alias("element"))
    met = (every.join(_small(held), "element").filter("a != b").select("a", "n_a", "b", "n_b", "element").distinct()
           .groupBy("a", "n_a", "b", "n_b").agg(F.count(F.lit(1)).alias("both")))
    alike = F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * percent
    return staged(met.filter(alike).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")


def _grouped(docs: DataFrame, key: str, text: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(texts, member): ``id, copy, node, n`` of every row, and ``node, comp, first_id, best`` of every set, ``best``
    being the set's smallest (no key, id, copy)."""
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.xxhash64(F.col(text)).alias("copy"),
                       F.col(text).alias("text"))
    longest = docs.agg(F.max(F.octet_length(F.col(text)))).first()[0] or 1
    bands = Bands.up_to(longest // 2 + 1, percent)
    weights = lambda level: F.col(level) + F.when(F.col("deletes_" + level), F.col(level + "_many")).otherwise(0)
    texts = staged(_summaries(rows, Scheme(bands, SALT), words).selectExpr("*", *_allowed(bands)), "text-sets")
    # Bands in which some set fills too few segments post deletions as well.
    few = (texts.filter("n > 0 and own <= own_most").select("band")
           .union(texts.filter("n > 0 and band > 0 and low <= low_most").select((F.col("band") - 1).alias("band"))))
    deleting = frozenset(r["band"] for r in few.distinct().collect())
    scheme = Scheme(bands, SALT, deleting)
    listed = [F.lit(int(b)) for b in sorted(deleting)] or [F.lit(-9)]
    texts = texts.withColumn("deletes_own", F.col("band").isin(*listed)).withColumn(
        "deletes_low", (F.col("band") - 1).isin(*listed))
    texts = texts.withColumn("own_weight", weights("own")).withColumn("low_weight", weights("low"))
    sets = texts.filter("n > 0").groupBy("node").agg(
        F.min(F.struct("id", "copy")).alias("rep"), F.min("id").alias("first_id"),
        F.min(F.struct(F.col("id").isNull().alias("no_key"), "id", "copy")).alias("best"),
        *[F.first(c).alias(c) for c in ("n", "own_weight", "own_most", "low_weight", "low_most", "band")])
    total = texts.agg(F.sum("n")).first()[0] or 0
    shares = max(8, ceil(total * 0.8 / ENTRIES))
    matched = _matched_weight(rows, scheme, words, shares)
    open_levels = (matched.groupBy("node").agg(
        F.max(F.when(F.col("level") == OWN, F.col("matched"))).alias("m_own"),
        F.max(F.when(F.col("level") == LOW, F.col("matched"))).alias("m_low")).join(sets, "node")
        .withColumn("own", F.coalesce(F.expr("own_weight - m_own <= own_most"), F.lit(False)))
        .withColumn("low", F.coalesce(F.expr("band > 0 and low_weight - m_low <= low_most"), F.lit(False)))
        .filter("own or low"))
    open_sets = staged(open_levels, "open-sets")

    wanted = _small(open_sets.select(F.col("rep.id").alias("_i"), F.col("rep.copy").alias("_c")))
    again = rows.join(wanted, F.col("id").eqNullSafe(F.col("_i")) & (F.col("copy") == F.col("_c")), "left_semi")
    read = _read_sets(again, words).dropDuplicates(["node"])
    elements = staged(open_sets.drop("n").join(read, "node"), "elements")
    postings = staged(_postings(elements, scheme), "postings")
    sketches = staged(_sketches(elements), "sketches")

    # The few sets that cannot prove what they must even so are compared by their elements.
    unproven = sets.filter("own_weight <= own_most or (band > 0 and low_weight <= low_most)")
    links, groups = _links_of(staged(unproven.select("rep"), "unproven-sets"), rows, words, percent), None
    for attempt in range(STAR_ROUNDS + 1):
        last = attempt == STAR_ROUNDS
        mixed = staged(_with_groups(postings.drop("probe") if last else postings.filter("probe").select("signature", "node"),
                                    groups), "mixed-postings")
        if last:
            cross = staged(_cross_pairs(mixed, elements, sketches, percent), "pairs")
            pairs = cross.filter(F.col("nth") <= STAR_PAIRS)
        else:
            pairs = _possible(_star_pairs(mixed, attempt), sketches, percent)
        found = staged(_verified(pairs, elements, percent), "links")
        links = found if links is None else links.union(found)
        groups = components(links)
    # What the nearest of each group did not link is compared with its others.
    others = staged(_between(cross.filter(F.col("nth") > STAR_PAIRS), groups), "pairs")
    if not others.isEmpty():
        groups = components(links.union(staged(_verified(others, elements, percent), "links")))
    groups = groups.join(sets.select("node"), "node", "left_semi")
    return texts, (sets.select("node", "first_id", "best").join(groups, "node", "left")
                   .withColumn("comp", F.coalesce("comp", "node")))


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                      percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``key, n_shingles, component_id``.

    A text's set holds its distinct runs of ``words`` words between white space, A-Z in lower case; with
    fewer words its whole sequence. Texts link when their sets' intersection is at least ``percent`` of
    their union. ``component_id`` is the smallest key reachable by links. Null, empty and blank texts
    have no shingles and their own key as component; a null key counts as no key (a component of such
    rows alone is null). Repeated rows link like other copies.
    """
    texts, member = _grouped(docs, key, text, words, percent)
    least = member.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    named = member.join(least, "comp").select("node", "component_id")
    out = texts.select("id", "node", "n").join(named, "node", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                percent: int = 80) -> DataFrame:
    """``docs`` with one document of every component, the one with the smallest key, then the smallest
    hash of its text; all columns kept. Rows without a key take part, after all others. Texts without words
    stay; of rows that repeat key and text one stays."""
    texts, member = _grouped(docs, key, text, words, percent)
    best = member.groupBy("comp").agg(F.min("best").alias("best"))
    kept = staged(best.select(F.col("best.id").alias("_i"), F.col("best.copy").alias("_c"))
                  .union(texts.filter("n = 0").select("id", "copy")).distinct(), "kept")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(key).cast("bigint").alias("id"), F.xxhash64(F.col(text)).alias("copy"))
    kept = _small(kept)
    stays = marked.join(kept, F.col("id").eqNullSafe(F.col("_i")) & (F.col("copy") == F.col("_c")), "left_semi")
    return stays.dropDuplicates(["id", "copy"]).select("row.*")
