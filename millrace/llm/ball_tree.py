"""Exact search for the largest inner products by ball trees.

Rows are dealt to shards by a few pivots, and each shard builds a ball tree. For a query q the inner product
with anything in a ball (centre c, radius r) is at most q.c + |q| r. A query looks at nodes in the order of
this bound and ends where it falls below its k-th score so far. That score travels with the query: first it
comes from a sample, then from the most promising shard; only shards whose own ball may beat it are asked.
All scores are integers and exact.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import staged

SCALE = 256
_HITS = "q bigint, ids array<bigint>, score bigint"


@dataclass(frozen=True)
class Settings:
    """``sample`` different vectors, the only sample, give the pivots of at most ``regions`` regions and the first
    bound of each query. A region is split at random into shards of about ``shard`` rows; a task searches a
    shard for ``block`` queries. ``leaf`` vectors end a tree."""

    sample: int = 4096
    regions: int = 256
    shard: int = 16_384
    block: int = 2048
    leaf: int = 64


def scaled(vector: Column) -> Column:
    """floor(256 x) of every component, in double precision, as integers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, and a squared length that 64 bits hold: then every
    inner product fits 64 bits, too."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    add = lambda s, x: s + F.pow(F.floor(x.cast("double") * SCALE).cast("double"), F.lit(2.0))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & (F.aggregate(vector, F.lit(0.0), add) < 9.0e18)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit integers: in doubles where no partial sum leaves 53 bits."""
    if _narrow(vectors, query):
        return (vectors.astype(np.float64) @ query.astype(np.float64).T).astype(np.int64)
    return vectors @ query.T


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


def bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products of queries (rows) with balls (columns), rounding allowed for."""
    inner, reach = queries.astype(np.float64) @ centres.T, np.outer(_lengths(queries), radii)
    slack = np.outer(_lengths(queries), _lengths(centres) + radii) * 1e-9
    return inner + reach + slack + 1


class BallTree:
    """Vectors in the order of the leaves. Node ``i`` covers rows ``lo[i]:hi[i]``; ``child[i]`` is its first child, the
    second follows it; 0 for a leaf."""

    def __init__(self, vectors: np.ndarray, leaf: int):
        self.order = np.arange(len(vectors))
        self.lo, self.hi, self.child = [0], [len(vectors)], [0]
        centres, radii, at = [], [], 0
        while at < len(self.lo):
            lo, hi = self.lo[at], self.hi[at]
            mine = vectors[self.order[lo:hi]].astype(np.float64)
            centre = mine.mean(axis=0)
            away = np.sqrt(((mine - centre) ** 2).sum(axis=1))
            centres.append(centre)
            radii.append(away.max() * (1 + 1e-9))
            if hi - lo > leaf:
                far = mine[away.argmax()]  # split between the row farthest out and the one farthest from that
                other = mine[((mine - far) ** 2).sum(axis=1).argmax()]
                side = np.argsort(mine @ (other - far), kind="stable")
                self.order[lo:hi] = self.order[lo:hi][side]
                middle = (lo + hi) // 2
                self.child[at] = len(self.lo)
                self.lo += [lo, middle]
                self.hi += [middle, hi]
                self.child += [0, 0]
            at += 1
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.vectors = vectors[self.order]

    def search(self, queries: np.ndarray, least: np.ndarray, first_id: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (rows of the vectors given, scores) of the best ``k`` that score at least ``least``, ties to the
        smaller ``first_id``."""
        limits = bounds(queries, self.centres, self.radii)
        ids = first_id[self.order]
        exact = self.vectors.astype(np.float64) if _narrow(self.vectors, queries) else self.vectors
        out = []
        for query, limit, bar in zip(queries.astype(exact.dtype), limits, least.tolist()):
            rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
            heap = [(-limit[0], 0)]
            while heap and -heap[0][0] >= bar:
                node = heapq.heappop(heap)[1]
                if child := self.child[node]:
                    for c in (child, child + 1):
                        if limit[c] >= bar:
                            heapq.heappush(heap, (-limit[c], c))
                    continue
                lo, hi = self.lo[node], self.hi[node]
                score = (exact[lo:hi] @ query).astype(np.int64)
                good = np.flatnonzero(score >= bar)
                rows, scores = np.append(rows, lo + good), np.append(scores, score[good])
                if len(rows) >= k:
                    kept = np.lexsort((ids[rows], -scores))[:k]
                    rows, scores = rows[kept], scores[kept]
                    bar = max(bar, int(scores[-1]))
            out.append((self.order[rows], scores))
        return out


def slices(batches, rows: int = 512):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _narrow(vectors: np.ndarray, queries: np.ndarray) -> bool:
    """Whether all inner products and their partial sums are whole numbers that doubles hold."""
    return float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * vectors.shape[1] < 2.0 ** 52


def _pivots(sample: np.ndarray, regions: int) -> np.ndarray:
    """Centres of up to ``regions`` leaves of a ball tree over the sample."""
    tree = BallTree(sample, max(1, -(-len(sample) // regions)))
    return np.array([c for c, child in zip(tree.centres, tree.child) if not child])[:regions]


def largest_products(table: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
                     settings: Settings = Settings()) -> DataFrame:
    """The ``k`` other rows with the largest inner product for every row of ``table`` for which ``queries`` holds:
    ``query_id, rank, vec_id, score``, largest first, ties to the smaller id; all if there are fewer.

    Vectors are scaled by 256 and rounded down to integers; scores are exact. Rows without an id and vectors that
    are null, empty, hold null or non-finite components, are of another length than most, or whose squared length
    does not fit 64 bits take no part. Rows that repeat an id and vector count once. An empty table gives no rows.
    """
    spark = table.sparkSession
    rows = (table.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vec"), queries.alias("asks"))
            .filter(usable(F.col("vec")) & F.col("id").isNotNull()))
    length = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    rows = rows.filter(F.size("vec") == length["d"]).withColumn("vec", scaled(F.col("vec")))
    # Copies are one vector with its smallest ids: later ones are never among the best k of anything.
    few = (rows.select("id", "vec").distinct().withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id")))
           .filter(F.col("n") <= k + 1))
    base = staged(few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")), "vectors")
    total = base.count()
    drawn = base.orderBy(F.xxhash64("vec"), "vec").limit(settings.sample).select("vec").collect()
    sample = np.array([r["vec"] for r in drawn], np.int64)
    pivots = _pivots(sample, max(1, min(settings.regions, total // settings.shard + 1)))

    def to_regions(batches):
        for batch in batches:
            vectors = _matrix(batch.column("vec")).astype(np.float64)
            away = (vectors ** 2).sum(axis=1)[:, None] - 2 * vectors @ pivots.T + (pivots ** 2).sum(axis=1)
            region = away.argmin(axis=1)
            # the distance itself without the cancellation of the shorter form
            true = np.sqrt(((vectors - pivots[region]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(region.astype(np.int32)), pa.array(true), *batch.columns],
                                             ["region", "away", *batch.schema.names])

    placed = staged(base.mapInArrow(to_regions, "region int, away double, vec array<bigint>, ids array<bigint>"), "placed-vectors")
    # One row a region, so at most ``regions`` rows.
    sizes = placed.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).orderBy("region").collect()
    parts = np.zeros(len(pivots), np.int64)
    radii = np.zeros(len(pivots))
    for region, n, radius in sizes:
        parts[region], radii[region] = -(-n // settings.shard), radius * (1 + 1e-9)
    region_bounds = lambda vectors: np.where(parts > 0, bounds(vectors, pivots, radii), -np.inf)
    starts = np.cumsum(parts) - parts
    # Both sides of a cogroup must have keys of one type: int and bigint are hashed to different partitions.
    listed = lambda values: F.array(*[F.lit(int(v)).cast("bigint") for v in values])
    start, many = listed(starts)[F.col("region")], listed(parts)[F.col("region")]
    shard = lambda column: (start + F.pmod(F.xxhash64(column), many)).alias("shard")
    sharded = placed.select(shard(F.col("ids")[0]), "vec", "ids")

    def promising(batches):
        for batch in slices(batches):
            vectors = _matrix(batch.column("vec"))
            least = np.full(len(vectors), np.iinfo(np.int64).min)
            if len(sample) > k:
                least = np.partition(products(sample, vectors), len(sample) - k - 1, axis=0)[len(sample) - k - 1]
            best = region_bounds(vectors).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least), pa.array(best.astype(np.int32))],
                                             ["q", "vec", "least", "region"])

    def remaining(batches):
        for batch in slices(batches):
            row, region = np.nonzero(region_bounds(_matrix(batch.column("vec"))) >= batch.column("least").to_numpy()[:, None])
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns], pa.array(region.astype(np.int32))],
                                             [*batch.schema.names, "region"])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        q, ids, scores = [], [], []
        if left.num_rows and right.num_rows:
            lists = left.column("ids").to_pylist()
            tree = BallTree(_matrix(left.column("vec")), settings.leaf)
            found = tree.search(_matrix(right.column("vec")), right.column("least").to_numpy(),
                                np.array([i[0] for i in lists], np.int64), k + 1)
            for name, (rows, score) in zip(right.column("q").to_pylist(), found):
                q += [name] * len(rows)
                ids += [lists[r] for r in rows]
                scores += score.tolist()
        return pa.table({"q": pa.array(q, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64())), "score": pa.array(scores, pa.int64())})

    def visit(asking: DataFrame, label: str) -> DataFrame:
        # A shard that many ask is searched for blocks of them.
        crowd = asking.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / settings.block).cast("int").alias("blocks"))
        crowd = F.broadcast(crowd)  # a row a shard
        left = (sharded.join(crowd, "shard").select("shard", F.explode(F.expr("sequence(0, blocks - 1)")).alias("b"), "vec", "ids"))
        right = asking.join(crowd, "shard").withColumn("b", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int")).drop("blocks")
        return staged(left.groupBy("shard", "b").cogroup(right.groupBy("shard", "b")).applyInArrow(search, _HITS), label)

    asked = rows.filter("asks").select("id", "vec").distinct()
    groups = staged(asked.groupBy("vec").agg(F.min("id").alias("q")), "queries")
    asking = staged(groups.select("q", "vec").mapInArrow(promising, "q bigint, vec array<bigint>, least bigint, region int")
                    .select("q", "vec", "least", shard("q")), "asking")
    near = visit(asking, "first-shard")
    bar = (near.groupBy("q").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
           .select("q", F.get("s", F.lit(k)).alias("reached")))
    raised = (asking.join(bar, "q", "left").select("q", "vec", F.greatest("least", "reached").alias("least"),
                                                   F.col("shard").alias("seen")))
    regions = raised.mapInArrow(remaining, "q bigint, vec array<bigint>, least bigint, seen bigint, region int")
    others = (regions.select("q", "vec", "least", "seen", F.explode(F.sequence(start, start + many - 1)).alias("shard"))
              .filter("shard != seen").drop("seen"))
    far = visit(staged(others, "asking-others"), "other-shards")

    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    hits = (near.union(far).select("q", F.explode("ids").alias("vec_id"), "score").withColumn("n", F.row_number().over(order))
            .filter(F.col("n") <= k + 1))
    lists = hits.groupBy("q").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("hits"))
    named = groups.join(lists, "q").select("vec", "hits")
    own = asked.join(named, "vec").select(F.col("id").alias("query_id"), F.expr(f"slice(filter(hits, h -> h.vec_id != id), 1, {k})").alias("hits"))
    return own.select("query_id", F.posexplode("hits").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score"))
