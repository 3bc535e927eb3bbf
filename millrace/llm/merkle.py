"""Merkle manifest of a dataset, with proofs expanded from one octopus multiproof for each run of leaves.

Rows are leaves, ordered by key within their group; every ``FAN`` consecutive nodes make a parent. The groups'
roots are the leaves of a tree above them. Leaves are range partitioned and cut into runs that need not be
aligned with the tree. A run sends up the largest nodes that lie wholly inside it; the few nodes above them,
which several runs share, are built level by level. For its proofs a run names the nodes that it cannot
derive itself, at most ``2 * (FAN - 1)`` a level, fetches all of them by one join, derives what its leaves
share, and expands the proof of every leaf.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import lookup_join
from millrace.operators.keys import number_rows
from millrace.session import staged

FAN_BITS = 3
FAN = 1 << FAN_BITS
RUN = 8192  # leaves
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits
_COORDINATE = "tree bigint, total bigint, level int, idx bigint, digest string"


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")),
                                        F.lit("-")) for f in fields]), 256)


def _digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(total: int) -> int:
    """Levels above the leaves."""
    return ((total - 1).bit_length() + FAN_BITS - 1) // FAN_BITS


def _height(total: Column) -> Column:
    digits = F.length(F.conv((total - 1).cast("string"), 10, FAN))
    return F.when(total > 1, digits).otherwise(0)


def nodes_at(level: int, total: int) -> int:
    return -(-total >> FAN_BITS * level) if total else 0


def inside(leaves: list[str], lo: int, total: int) -> list[tuple[int, list[str]]]:
    """By level, (first index, digests) of the nodes all of whose leaves are ``leaves``, which begin at place ``lo`` of
    ``total``."""
    hi, levels = lo + len(leaves), [(lo, leaves)]
    for level in range(1, height(total) + 1):
        below, children = levels[-1]
        first = -(-lo >> FAN_BITS * level)
        end = nodes_at(level, total) if hi == total else hi >> FAN_BITS * level
        levels.append((first, [_digest(children[j * FAN - below:(j + 1) * FAN - below]) for j in range(first, end)]))
    return levels


def frontier(leaves: list[str], lo: int, total: int) -> list[tuple[int, int, str]]:
    """(level, index, digest) of the nodes of :func:`inside` whose parent is not among them."""
    levels = inside(leaves, lo, total)
    out = []
    for level, (first, digests) in enumerate(levels):
        up, parents = levels[level + 1] if level + 1 < len(levels) else (0, [])
        out += [(level, first + i, d) for i, d in enumerate(digests) if not 0 <= ((first + i) >> FAN_BITS) - up < len(parents)]
    return out


class Octopus:
    """Proofs of the leaves at ``lo`` .. ``lo + len(leaves) - 1`` of ``total`` from these and the fetched nodes: all nodes
    that proofs of some of the leaves name, but for those on the way from a leaf to the root."""

    def __init__(self, leaves: list[str], lo: int, total: int, fetched: dict[tuple[int, int], str]):
        self.lo, self.sides, self.first = lo, [], []
        path, first = leaves, lo
        for level in range(height(total)):
            base = first >> FAN_BITS << FAN_BITS
            end = min(((first + len(path) - 1 >> FAN_BITS) + 1) << FAN_BITS, nodes_at(level, total))
            row = ([fetched[level, i] for i in range(base, first)] + path
                   + [fetched[level, i] for i in range(first + len(path), end)])
            runs = [row[i:i + FAN] for i in range(0, len(row), FAN)]
            sides = [("".join(run[:i]), "".join(run[i + 1:])) for run in runs for i in range(len(run))]
            self.sides.append(sides[first - base:first - base + len(path)])
            self.first.append(first)
            path, first = [_digest(run) for run in runs], first >> FAN_BITS
        self.root = path[0]
        # what a proof says from a level on is the same for all leaves below a node
        self._above = [[""]]
        for level in range(height(total) - 1, 0, -1):
            up, above = (self.first[level + 1] if level + 1 < len(self.first) else 0), self._above[-1]
            self._above.append([a + b + above[((self.first[level] + i) >> FAN_BITS) - up]
                                for i, (a, b) in enumerate(self.sides[level])])
        self._above.reverse()

    def proof(self, place: int) -> str:
        """Digests of the siblings, level by level, left to right."""
        if not self.sides:
            return ""
        up = self.first[1] if len(self.first) > 1 else 0
        return "".join(self.sides[0][place - self.lo]) + self._above[0][(place >> FAN_BITS) - up]

    def fold(self, place: int, leaf: str) -> str:
        """Root that follows from a leaf at a place and its proof."""
        for level, sides in enumerate(self.sides):
            before, after = sides[(place >> FAN_BITS * level) - self.first[level]]
            leaf = _digest([before, leaf, after])
        return leaf


def _runs(ranged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``part, grp, begin, n, before, total, tree`` for every group in every range, the groups' numbers)."""
    part = F.shiftright("at", _ROW_BITS)
    sizes = staged(ranged.groupBy(part.alias("part"), "grp").agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("n")), "leaf-runs")
    groups = staged(number_rows(sizes.groupBy("grp").agg(F.sum("n").alias("total")), "grp", "tree"), "leaf-groups")
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(groups, "grp"), groups)


def _trunk(nodes: DataFrame, levels: int) -> DataFrame:
    """All of ``nodes`` (``_COORDINATE``) and every node above them, level by level; each has FAN times fewer rows."""
    found = None
    below = None
    for level in range(levels + 1):
        here = nodes.filter(F.col("level") == level)
        if below is not None:
            children = F.array_sort(F.collect_list(F.struct("idx", "digest")))
            made = (below.filter(_height(F.col("total")) >= level).groupBy("tree", "total", F.shiftright("idx", FAN_BITS).alias("up"))
                    .agg(F.sha2(F.array_join(children["digest"], ""), 256).alias("digest"))
                    .select("tree", "total", F.lit(level).alias("level"), F.col("up").alias("idx"), "digest"))
            here = here.unionByName(made)
        below = staged(here, "tree-nodes")
        found = below if found is None else found.unionByName(below)
    return found


def _missing(runs: DataFrame, run: str, tree: Column, lo: Column, hi: Column, total: Column) -> DataFrame:
    """``run, tree, level, idx``: the nodes that proofs of the leaves ``lo`` .. ``hi - 1`` need and these do not give."""
    levels = F.when(_height(total) > 0, F.sequence(F.lit(0), _height(total) - 1)).otherwise(F.array().cast("array<int>"))
    at = runs.select(F.col(run).alias("run"), tree.alias("tree"), lo.alias("lo"), (hi - 1).alias("last"), total.alias("total"),
                     F.explode(levels).alias("level"))
    down = lambda c: F.expr(f"shiftright({c}, {FAN_BITS} * level)")
    at = at.select("run", "tree", "level", down("lo").alias("j"), down("last").alias("k"), (down("(total - 1)") + 1).alias("many"))
    between = lambda a, b: f"if({a} < {b}, sequence({a}, {b} - 1), cast(array() as array<bigint>))"
    left, right = between(f"j div {FAN} * {FAN}", "j"), between("k + 1", f"least((k div {FAN} + 1) * {FAN}, many)")
    return at.select("run", "tree", "level", F.explode(F.expr(f"concat({left}, {right})")).alias("idx"))


def manifest(rows: DataFrame, key: str, group: str, leaf: Column, forged: Column | None = None, run: int = RUN) -> DataFrame:
    """Every row as a leaf with its proof: ``key, group, leaf, subroot, root, proof, folded_root, verified``.

    ``leaf`` is the row's digest, ``forged`` another one to be folded in its place where it is not null. Within a group rows
    are ordered by key, no key first, then by leaf; groups by their value, null first. ``subroot`` is the root of the
    group, ``root`` that of all groups, ``proof`` the hex digests of the siblings from the leaf up to the root,
    ``folded_root`` what the (forged) leaf and the proof make, ``verified`` whether that is the root. Repeated rows
    are leaves of their own. No rows give no rows. Only digests, keys and groups are shuffled.
    """
    spark = rows.sparkSession
    # The row's number parts equal rows, so that one key of very many rows is cut into ranges, too.
    leaves = staged(rows.select(F.struct(F.col(group).alias("g")).alias("grp"), F.col(key).alias("key"), F.unhex(leaf).alias("leaf"),
                                (F.unhex(forged) if forged is not None else F.lit(None).cast("binary")).alias("forged"),
                                F.monotonically_increasing_id().alias("nth")), "leaves")
    order = ["grp", "key", "leaf", "nth"]
    ranged = staged(leaves.repartitionByRange(*order).sortWithinPartitions(*order).drop("nth")
                    .withColumn("at", F.monotonically_increasing_id()), "leaf-ranges")
    runs, groups = _runs(ranged)
    runs = staged(runs, "leaf-run-places")
    most, trees = groups.agg(F.max("total"), F.count(F.lit(1))).first()
    kinds = f"`{key}` {leaves.schema['key'].dataType.simpleString()}, `{group}` {leaves.schema['grp'].dataType[0].dataType.simpleString()}"
    if not trees:
        return spark.createDataFrame([], f"{kinds}, leaf string, subroot string, root string, proof string, folded_root string, verified boolean")
    nth = F.expr(f"(at - begin) div {run}") * run
    placed = lookup_join(ranged.withColumn("part", F.shiftright("at", _ROW_BITS)), runs, ["part", "grp"], "inner").select(
        (F.col("begin") + nth).alias("run"), "tree", "total", (F.col("before") + F.col("at") - F.col("begin")).alias("place"),
        "key", F.col("grp.g").alias("grp"), "leaf", "forged")

    def send_up(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        tree, total, lo = (group.column(c)[0].as_py() for c in ("tree", "total", "place"))
        nodes = frontier([d.hex() for d in group.column("leaf").to_pylist()], lo, total)
        return pa.table({"tree": pa.array([tree] * len(nodes), pa.int64()), "total": pa.array([total] * len(nodes), pa.int64()),
                         "level": pa.array([n[0] for n in nodes], pa.int32()), "idx": pa.array([n[1] for n in nodes], pa.int64()),
                         "digest": pa.array([n[2] for n in nodes], pa.string())})

    sent = staged(placed.select("run", "tree", "total", "place", "leaf").groupBy("run").applyInArrow(send_up, _COORDINATE), "frontier")
    below = _trunk(sent, height(most))
    tops = below.filter(F.col("level") == _height(F.col("total"))).select(
        F.lit(0).cast("bigint").alias("tree"), F.lit(trees).cast("bigint").alias("total"), F.lit(0).alias("level"),
        (F.col("tree") - 1).alias("idx"), "digest")
    above = _trunk(tops, height(trees))  # tree 0: its leaves are the groups' roots
    root = above.filter(F.col("level") == height(trees)).first()["digest"]

    cut = runs.select("tree", "total", "before", "n", "begin", F.explode(F.expr(f"sequence(0, (n - 1) div {run})")).alias("i")).select(
        (F.col("begin") + F.col("i") * run).alias("run"), "tree", "total", (F.col("before") + F.col("i") * run).alias("lo"),
        (F.col("before") + F.least(F.col("n"), (F.col("i") + 1) * run)).alias("hi"))
    needed = (_missing(cut, "run", F.col("tree"), F.col("lo"), F.col("hi"), F.col("total"))
              .union(_missing(cut, "run", F.lit(0).cast("bigint"), F.col("tree") - 1, F.col("tree"), F.lit(trees).cast("bigint"))))
    nodes = below.unionByName(above).select("tree", "level", "idx", "digest")
    fetched = lookup_join(needed, nodes, ["tree", "level", "idx"], "inner").select("run", "tree", "level", "idx", "digest")

    def prove(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("place")
        tree, total, lo = (left.column(c)[0].as_py() for c in ("tree", "total", "place"))
        given: dict[bool, dict] = {False: {}, True: {}}
        for at, level, idx, digest in zip(*[right.column(c).to_pylist() for c in ("tree", "level", "idx", "digest")]):
            given[at == 0][level, idx] = digest
        leaves = [d.hex() for d in left.column("leaf").to_pylist()]
        folded = [f.hex() if f is not None else d for f, d in zip(left.column("forged").to_pylist(), leaves)]
        own = Octopus(leaves, lo, total, given[False])
        top = Octopus([own.root], tree - 1, trees, given[True])
        last = top.proof(tree - 1)
        ends = [top.fold(tree - 1, own.fold(lo + i, d)) for i, d in enumerate(folded)]
        return pa.table({key: left.column("key"), group: left.column("grp"), "leaf": pa.array(leaves, pa.string()),
                         "subroot": pa.array([own.root] * len(leaves), pa.string()), "root": pa.array([root] * len(leaves), pa.string()),
                         "proof": pa.array([own.proof(lo + i) + last for i in range(len(leaves))], pa.string()),
                         "folded_root": pa.array(ends, pa.string()), "verified": pa.array([e == root for e in ends], pa.bool_())})

    return placed.groupBy("run").cogroup(fetched.groupBy("run")).applyInArrow(
        prove, f"{kinds}, leaf string, subroot string, root string, proof string, folded_root string, verified boolean")
