"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import staged


def _contract(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (``large``) or smaller neighbours of every node on its smallest one."""
    swapped = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    both = swapped.union(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))) if large else swapped
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hung = both.join(least, "u")
    moved = hung.filter(F.col("v") > F.col("u")) if large else hung
    pairs = moved.select(F.col("m").alias("a"), F.col("v").alias("b"))
    if not large:
        pairs = pairs.union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return pairs.filter(F.col("a") < F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``edges`` (columns ``a``, ``b``; any order, repeats and loops
    allowed) but the roots: ``comp`` is the smallest node of the component. Nodes are not null.

    Every round is written, so a lost executor repeats at most one of them; the number of rounds
    grows with the logarithm of the longest chain.
    """
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .filter(F.col("a") < F.col("b")).distinct(), "edges")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = None
    while (now := mark(edges)) != before:
        before = now
        edges = staged(_contract(_contract(edges, True), False), "edges")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("comp"))
