"""Nearest vectors by a permutation index.

A vector is represented by the order in which it sees a set of pivots, nearest first. It is posted
in the inverted files of its nearest pivots; a query reads the files of its own nearest pivots,
ranks what it finds there by the footrule distance between the two orders, and reranks the best
share by the true measure.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import staged


@dataclass(frozen=True)
class Settings:
    """``pivots`` vectors are drawn as pivots, the only sample. A vector is posted with ``posts``
    pivots and a query reads ``probes`` files. In every block of a file the share ``rerank`` with
    the least footrule distance, ties included, is compared exactly. Measured for vectors without
    any clusters, the hardest case; clustered ones need less."""

    pivots: int = 128
    posts: int = 2
    probes: int = 72
    rerank: float = 0.2
    block: int = 4096


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def orders(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Pivots by nearness for every vector, nearest first, ties to the earlier pivot."""
    return np.argsort(-(unit @ pivots.T), axis=1, kind="stable")


def _places(order: np.ndarray) -> np.ndarray:
    place = np.empty(order.shape, np.int16)
    np.put_along_axis(place, order, np.arange(order.shape[1], dtype=np.int16)[None, :], axis=1)
    return place


def usable(vector: Column) -> Column:
    """Not null, not all zero, and every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def distinct_vectors(rows: DataFrame, key: str, vector: str, keep: int) -> DataFrame:
    """``vec, ids``: each different vector with its ``keep`` smallest ids. Later ids of the same vector
    can never be among the nearest ``keep`` of anything; every map task already sends no more."""
    order = Window.partitionBy("vec").orderBy("id")
    few = (rows.select(F.col(key).alias("id"), F.col(vector).alias("vec"))
           .withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= keep))
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def nearest(table: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
            settings: Settings = Settings()) -> DataFrame:
    """The ``k`` nearest other rows by cosine of every row of ``table`` for which ``queries`` holds:
    ``query_id, rank, vec_id, score``, nearest first, ties to the smaller id; all if there are fewer.

    Rows whose id is null or whose vector is null, empty, zero, not finite or of another length than most
    take no part. Rows that repeat an id and vector count once. An empty table gives no rows.
    """
    spark = table.sparkSession
    rows = table.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vec"), queries.alias("asks"))
    rows = rows.filter(usable(F.col("vec")) & F.col("id").isNotNull()).distinct()
    length = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.filter(F.size("vec") == length["d"])
    base = staged(distinct_vectors(rows, "id", "vec", k + 1), "vectors")
    asked = rows.filter("asks").select("id", "vec")
    drawn = base.orderBy(F.xxhash64("vec"), "vec").limit(settings.pivots).select("vec").collect()
    pivots = _unit(np.array([r["vec"] for r in drawn], np.float64))
    posts, probes = min(settings.posts, len(pivots)), min(settings.probes, len(pivots))
    item = base.schema["vec"].dataType.simpleString()

    def files(n):
        def run(batches):
            for batch in batches:
                order = orders(_unit(_matrix(batch.column("vec"))), pivots)[:, :n].astype(np.int32)
                at = pa.array(np.repeat(np.arange(batch.num_rows), n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(order.ravel()), *[c.take(at) for c in batch.columns]], ["pivot", *batch.schema.names])

        return run

    posted = base.mapInArrow(files(posts), f"pivot int, vec {item}, ids array<bigint>")
    asking = (asked.groupBy("vec").agg(F.min("id").alias("q")).select("q", "vec")
              .mapInArrow(files(probes), f"pivot int, q bigint, vec {item}"))
    # A file that is long, or read by many queries, is laid out as a grid of blocks.
    blocks = lambda df, name: df.groupBy("pivot").agg(
        F.ceil(F.count(F.lit(1)) / settings.block).cast("int").alias(name))
    grid = F.broadcast(blocks(posted, "rows").join(blocks(asking, "asks"), "pivot"))
    posted = (posted.join(grid, "pivot").withColumn("r", F.pmod(F.xxhash64(F.col("ids")[0]), F.col("rows")).cast("int"))
              .select("pivot", "r", F.explode(F.expr("sequence(0, asks - 1)")).alias("a"), "vec", "ids"))
    asking = (asking.join(grid, "pivot").withColumn("a", F.pmod(F.xxhash64("q"), F.col("asks")).cast("int"))
              .select("pivot", F.explode(F.expr("sequence(0, rows - 1)")).alias("r"), "a", "vec", "q"))
    share = settings.rerank

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            vectors = _unit(_matrix(left.column("vec").combine_chunks()))
            asked_for = _unit(_matrix(right.column("vec").combine_chunks()))
            seen, own = _places(orders(vectors, pivots)), _places(orders(asked_for, pivots))
            ids = left.column("ids").to_pylist()
            count = min(len(ids), max(k + 1, int(np.ceil(share * len(ids)))))
            for i, q in enumerate(right.column("q").to_pylist()):
                footrule = np.abs(seen - own[i]).sum(axis=1, dtype=np.int32)
                picked = np.flatnonzero(footrule <= np.partition(footrule, count - 1)[count - 1])
                score = (vectors[picked] * asked_for[i]).sum(axis=1)
                first = score >= np.partition(score, -min(k + 1, len(score)))[-min(k + 1, len(score))]
                out += [(q, ids[j], s) for j, s in zip(picked[first].tolist(), score[first].tolist())]
        return pa.table({"q": pa.array([o[0] for o in out], pa.int64()),
                         "ids": pa.array([o[1] for o in out], pa.list_(pa.int64())),
                         "score": pa.array([o[2] for o in out], pa.float64())})

    found = (posted.groupBy("pivot", "r", "a").cogroup(asking.groupBy("pivot", "r", "a"))
             .applyInArrow(search, "q bigint, ids array<bigint>, score double"))
    # A vector posted with two pivots may be met twice; k + 1 because the query itself is among them.
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = (found.groupBy("q", "ids").agg(F.max("score").alias("score"))
             .select("q", F.explode("ids").alias("vec_id"), "score")
             .withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1).drop("_n"))
    lists = found.groupBy("q").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("l"))
    names = asked.join(asked.groupBy("vec").agg(F.min("id").alias("q")), "vec").select("q", F.col("id").alias("query_id"))
    own = names.join(lists, "q").select("query_id", F.expr(
        f"slice(filter(l, x -> x.vec_id != query_id), 1, {k})").alias("l"))
    return own.select("query_id", F.posexplode("l").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.s")).alias("score"))
