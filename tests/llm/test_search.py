"""Lexical search, ball-tree search and Merkle manifest against plain versions and on odd input."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ball_tree, lexical, merkle, queries

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def plain_ranking(docs, items, k):
    words = [terms(t) for _, t in docs]
    n_docs, length = sum(bool(w) for w in words), sum(map(len, words))
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, of in wanted.items():
        scored = []
        for (key, _), w in zip(docs, words):
            score = 0
            for t in of & set(w):
                df = sum(t in x for x in words)
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                m = 50 + (50 * len(w) * n_docs) // length
                score += weight * ((1000000000 * w.count(t)) // (1000 * w.count(t) + 20 * m))
            if score > 0:
                scored.append((-score, key is None, key))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, i + 1, key, -s) for i, (s, _, key) in enumerate(scored[:k])]
    return sorted(out, key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("slice_bytes", [lexical.SLICE_BYTES, 300])
def test_ranking_against_plain(spark, monkeypatch, slice_bytes):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünï", "ſ", "naïve", "X9", "the"]
    docs = [(i, rng.choice([" ", "--", "\n", "."]).join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(150)]
    docs += [(7, "the the w1"), (7, "the the w1"), (None, "w1 w2 X9"), (None, None), (200, ""), (201, "W1W2 w12")]
    items = [(i, " ".join(rng.choices(vocabulary + ["absent"], k=rng.randint(1, 12)))) for i in range(12)]
    items += [(3, "w1 w2"), (50, None), (51, "!!"), (None, "w1 w2"), (52, "absent")]
    monkeypatch.setattr(lexical, "ENTRIES", 40)
    monkeypatch.setattr(lexical, "PIECE_BYTES", 16)
    got = lexical.rank_documents(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                 spark.createDataFrame(items, "item_id bigint, text string"), k=9, slice_bytes=slice_bytes)
    assert sorted(map(tuple, got.collect())) == plain_ranking(docs, items, 9)


def test_ranking_on_odd_input(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "MIT license"), (2, "word more")], "item_id bigint, text string")
    got = lexical.rank_documents(odd_docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert [(r.item_id, r.rank, r.doc_id) for r in got.orderBy("item_id", "rank").collect()] == [(1, 1, 1), (2, 1, 5), (2, 2, 5)]
    assert lexical.rank_documents(no_docs, items).count() == 0
    assert lexical.rank_documents(odd_docs, items.limit(0)).count() == 0
    named = lexical.rank_documents(spark.createDataFrame([("b", "x y z"), ("a", "x y z"), ("c", "q")], "doc_id string, text string"),
                                   spark.createDataFrame([("i", "x")], "item_id string, text string"))
    assert [(r.item_id, r.rank, r.doc_id) for r in named.orderBy("rank").collect()] == [("i", 1, "a"), ("i", 2, "b")]


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("Alpha beta," * 5 + "x" * 50 + " gamma ") * 20
    whole = lexical.count_terms(lexical.automaton(["alpha", "beta", "gamma", "x" * 50]), text.encode())
    monkeypatch.setattr(lexical, "PIECE_BYTES", 7)
    assert lexical.count_terms(lexical.automaton(["alpha", "beta", "gamma", "x" * 50]), text.encode()) == whole
    assert whole[0] == len(terms(text)) and whole[1][0] == terms(text).count("alpha")


def test_length_factor_beyond_64_bits():
    n = np.array([10 ** 9, 5])
    got = lexical.length_factor(n, 10 ** 10, 10 ** 12)
    assert got.tolist() == [50 + (50 * int(x) * 10 ** 10) // 10 ** 12 for x in n]


def plain_products(rows, k):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v)

    lengths = [len(v) for _, v in rows if usable(v)]
    most = max(set(lengths), key=lambda n: (lengths.count(n), -n)) if lengths else 0
    kept = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and usable(v) and len(v) == most}
    kept = [(i, v) for i, v in kept if sum(c * c for c in v) < 9e18]
    out = []
    for q, v in kept:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in kept if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("wide", [1.0, 1e6])
def test_products_against_plain(spark, wide):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 12))
    vectors = (centres[rng.integers(0, 8, 900)] + rng.normal(scale=0.3, size=(900, 12))) * wide
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(2000 + i, vectors[100].tolist()) for i in range(60)]  # many copies of a query's vector
    rows += [(3000, None), (3050, []), (3100, [None] * 12), (3150, [float("nan")] * 12), (3200, [float("inf")] * 12),
             (3250, [0.0] * 12), (3300, [1.0] * 5), (None, vectors[0].tolist()), (0, vectors[0].tolist()), (3350, [1e30] * 12)]
    settings = ball_tree.Settings(sample=64, regions=8, shard=40, block=7, leaf=4)
    got = ball_tree.largest_products(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0,
                                     settings=settings)
    assert sorted(map(tuple, got.collect())) == plain_products(rows, 5)


def test_products_of_shards_in_different_partitions(spark, monkeypatch):
    """No shard is lost where the two sides of a search are not coalesced into one partition, nor a zero query."""
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1200, 12)))] + [(5000, [0.0] * 12)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    settings = ball_tree.Settings(sample=64, regions=8, shard=40, block=7, leaf=4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = lambda: sorted(map(tuple, ball_tree.largest_products(table, F.col("vec_id") % 50 == 0, settings=settings).collect()))
        assert found() == plain_products(rows, 5)
        far = np.full((1, 12), 1e9)  # nothing is nearest to this one: a region without rows
        pivots = ball_tree._pivots
        monkeypatch.setattr(ball_tree, "_pivots", lambda *a: np.concatenate([far, pivots(*a)]))
        assert found() == plain_products(rows, 5)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_few_products(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string, ids string")
    asks = F.col("vec_id") % 50 == 0
    assert ball_tree.largest_products(make([]), asks).count() == 0
    assert ball_tree.largest_products(make([(50, [1.0], "x", "y")]), asks).count() == 0
    got = ball_tree.largest_products(make([(0, [1.0, 0.5], "x", "y"), (1, [-1.0, 0.0], "x", "y"), (50, [1.0, 0.5], "x", "y")]), asks)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 50, 81920), (0, 2, 1, -65536), (50, 1, 0, 81920), (50, 2, 1, -65536)]


def test_a_tree_looks_at_few_vectors():
    """Where vectors lie in clusters most of the tree is never reached."""
    rng = np.random.default_rng(8)
    vectors = (rng.normal(size=(40, 16))[rng.integers(0, 40, 4000)] * 256 + rng.normal(scale=9, size=(4000, 16))).astype(np.int64)
    tree = ball_tree.BallTree(vectors, 32)
    query, least = vectors[:1], np.full(1, np.iinfo(np.int64).min)
    best = tree.search(query, least, np.arange(4000), 6)[0]
    exact = vectors @ query[0]
    assert sorted(best[1].tolist(), reverse=True) == np.sort(exact)[::-1][:6].tolist()
    limits = ball_tree.bounds(query, tree.centres, tree.radii)[0]
    leaves = [i for i, c in enumerate(tree.child) if not c]
    reached = sum(tree.hi[i] - tree.lo[i] for i in leaves if limits[i] >= best[1].min())
    assert reached < 0.25 * len(vectors)
    for i in range(len(tree.lo)):  # every bound holds
        assert exact[tree.order[tree.lo[i]:tree.hi[i]]].max() <= limits[i]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """Rows (key, group, leaf, forged) with proofs, by whole trees."""
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def way(levels, place, leaf):
        proof = ""
        for level in levels[:-1]:
            run = place // 8 * 8
            before, after = level[run:place], level[place + 1:run + 8]
            proof += "".join(before + after)
            leaf = digest(*before, leaf, *after)
            place //= 8
        return proof, leaf

    trees = {g: tree([r[2] for r in groups[g]]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for i, g in enumerate(names):
        for place, (key, _, leaf, forged) in enumerate(groups[g]):
            proof, folded = way(trees[g], place, forged or leaf)
            more, folded = way(top, i, folded)
            out.append((key, g, leaf, trees[g][-1][0], top[-1][0], proof + more, folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("run", [merkle.RUN, 5])
def test_manifest_against_plain(spark, run):
    rng = random.Random(2)
    rows = [(rng.randrange(3000), rng.choice(["en", "de", "de", "de"]), digest(str(i)), digest("f", str(i)) if i % 3 else None)
            for i in range(700)]
    rows += [(i, f"g{i}", digest("g", str(i)), None) for i in range(20)] + [(1, None, digest("n"), None), (None, "en", digest("k"), None)]
    rows += [(42, "fr", digest("same"), None)] * 90
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, h string, f string")
    got = merkle.manifest(docs, "doc_id", "lang", F.col("h"), F.col("f"), run=run)
    assert sorted(map(tuple, got.collect()), key=str) == plain_manifest(rows)


@pytest.mark.parametrize("total", [1, 2, 8, 9, 64, 65, 600])
def test_octopus_needs_only_what_is_named(spark, total):
    """The nodes asked for are those no leaf of the run leads to, and they are enough."""
    leaves = [digest(str(i)) for i in range(total)]
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    rng = random.Random(total)
    cuts = [(lo, rng.randint(lo + 1, total)) for lo in [rng.randrange(total) for _ in range(5)]] + [(0, total)]
    runs = spark.createDataFrame([(i, lo, hi, total) for i, (lo, hi) in enumerate(cuts)], "run bigint, lo bigint, hi bigint, total bigint")
    named = merkle._missing(runs, "run", F.lit(1), F.col("lo"), F.col("hi"), F.col("total")).collect()
    for i, (lo, hi) in enumerate(cuts):
        asked = {(r.level, r.idx) for r in named if r.run == i}
        onway = {(level, place >> 3 * level) for place in range(lo, hi) for level in range(len(levels))}
        assert asked == {(level, j) for level, up in onway if level + 1 < len(levels)
                         for j in range(up // 8 * 8, min(up // 8 * 8 + 8, len(levels[level])))} - onway
        octopus = merkle.Octopus(leaves[lo:hi], lo, total, {c: levels[c[0]][c[1]] for c in asked})
        assert octopus.root == levels[-1][0] and all(octopus.fold(p, leaves[p]) == octopus.root for p in range(lo, hi))
        assert total == 1 or octopus.fold(lo, digest("forged")) != octopus.root


def test_manifest_on_odd_input(spark, odd_docs, no_docs):
    rows = queries.manifest_digest(odd_docs).collect()
    assert len(rows) == odd_docs.count() and len({r.root for r in rows}) == 1
    changed = {r.doc_id for r in rows if not r.verified}
    assert changed == {k for k in range(1, 10) if zlib.crc32(str(k).encode()) % 3 == 0
                       and any(r.text and r.text != r.text.translate(UPPER) for r in odd_docs.filter(F.col("doc_id") == k).collect())}
    assert queries.manifest_digest(no_docs).count() == 0
    one = queries.manifest_digest(odd_docs.filter("doc_id = 9")).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == digest("") and one.verified
