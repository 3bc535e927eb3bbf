"""Classifiers on held-out labels, the permutation index against brute force, and packing as a round trip."""

import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import packing, permutation_index, quality, queries, toxicity
from millrace.llm.bytewords import ALNUM, VISIBLE, chunks, hash_of, ngrams

BIG = "/root/testdata/sf0.1"


def outcome(spark, name, label, threshold):
    rows = queries.QUERIES[name][0](spark, BIG).join(queries.table(spark, BIG, "labels"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= threshold)
    held = [(r.predicted, r[label]) for r in rows if r.held_out]
    rate = lambda p, y: sum(a == p and b == y for a, b in held) / sum(b == y for _, b in held)
    return rate(1, 1), rate(0, 0)


def test_quality_on_held_out_labels(spark):
    kept, out = outcome(spark, "op3_quadratic_discriminant", "quality", 0.3)
    assert kept > 0.99 and out > 0.97


def test_toxicity_on_held_out_labels(spark):
    caught, clean = outcome(spark, "op4_factorization_machine", "toxic", 0.5)
    assert caught > 0.85 and clean > 0.99


def test_pairs_matter():
    """A label that is true only where two terms meet cannot be learnt by weights alone."""
    rng = np.random.default_rng(0)
    texts = ["x%d y%d %s %s" % (rng.integers(50), rng.integers(50), a, b)
             for a, b in zip(rng.choice(["insult", "plain"], 4000), rng.choice(["group", "thing"], 4000))]
    label = np.array(["insult" in t and "group" in t or "plain" in t and "thing" in t for t in texts], float)
    found, bounds = toxicity.terms(pa.array(texts))
    right = lambda m: ((m.score(found, bounds) >= 0.5) == label).mean()
    assert right(toxicity.learn(found, bounds, label, steps=300)) > 0.99
    assert right(toxicity.learn(found, bounds, label, steps=300, factors=0)) < 0.7


def test_machine_against_sum_over_pairs():
    """The logit is the bias, the terms' weights, and the products of the vectors of all pairs of terms."""
    rng = np.random.default_rng(5)
    texts = ["", None, "one"] + [" ".join(rng.choice(["alpha", "bravo", "charlie", "delta", "echo", "x"], 9)) for _ in range(60)]
    found, bounds = toxicity.terms(pa.array(texts))
    label = np.array([bool(t and "alpha" in t and "x" in t.split()) for t in texts], float)
    machine = toxicity.learn(found, bounds, label, steps=40)
    assert set(np.flatnonzero(machine.place >= 0)) == set(found)  # every term has learnt
    assert (machine.weight != 0).all() and (machine.factors != 0).all()
    other, other_bounds = toxicity.terms(pa.array([*texts, "unseen words only", "alpha unseen"]))
    got = machine.logit(other, other_bounds)
    for i, value in enumerate(got):
        rows = [machine.place[t] for t in other[other_bounds[i]:other_bounds[i + 1]] if machine.place[t] >= 0]
        want = machine.bias + sum(machine.weight[r] for r in rows)
        want += sum(machine.factors[a] @ machine.factors[b] for a, b in itertools.combinations(rows, 2))
        assert abs(value - want) < 1e-9


def test_blocks_of_texts_learn_alike(monkeypatch):
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["w%d" % i for i in range(30)], 6)) for _ in range(200)]
    found, bounds = toxicity.terms(pa.array(texts))
    label = np.array(["w1" in t.split() or "w2" in t.split() for t in texts], float)
    whole = toxicity.learn(found, bounds, label, steps=20)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    parts = toxicity.learn(found, bounds, label, steps=20)
    assert np.allclose(whole.weight, parts.weight) and np.allclose(whole.factors, parts.factors)


def test_mahalanobis_by_cholesky():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4)) @ rng.normal(size=(4, 4))
    cov, mean = np.cov(x.T) + np.eye(4) * 0.1, x.mean(axis=0)
    got = quality.Gaussian.of(mean, cov).log_density(x)
    want = [-0.5 * (r - mean) @ np.linalg.inv(cov) @ (r - mean) - 0.5 * math.log(np.linalg.det(cov)) for r in x]
    assert np.allclose(got, want)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, 1), (5, 1)], [(1, 0), (5, 1), (6, 7), (None, 1)]])
def test_classifiers_with_few_labels(spark, odd_docs, no_docs, rows):
    labels = spark.createDataFrame(rows, "doc_id bigint, label int")
    for operator in (quality, toxicity):
        model = operator.fit(odd_docs, labels, "label")
        scores = operator.score(odd_docs, model).collect()
        assert len(scores) == odd_docs.count() and all(0 <= r.score <= 1 for r in scores)
        assert operator.score(no_docs, model).count() == 0
    model = quality.fit(odd_docs, labels, "label")
    assert quality.accepted(odd_docs, model, 0.0).count() == odd_docs.count()


def test_moments_need_one_worker_a_task(spark):
    """Two Python steps in one stage keep two workers a task, beside those of the stage before."""
    docs = spark.createDataFrame([(i, f"some text {i} " * (1 + i % 7) + "." * (i % 3)) for i in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 3) for i in range(40)], "doc_id bigint, label int")
    found = quality.class_moments(docs, labels, "label")
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    x = quality.statistics(pa.array([r.text for r in docs.orderBy("doc_id").collect()]))
    rows = {r.label: r for r in found.collect()}
    assert set(rows) == {0, 1}
    for c, r in rows.items():
        own = x[c::3]
        assert r.rows == len(own) and np.allclose(r.sums, own.sum(axis=0))
        assert np.allclose(r.products, (own.T @ own)[np.triu_indices(quality.FEATURES)])


def test_repeated_keys_teach_once(spark, monkeypatch):
    docs = [(1, f"text number {i}") for i in range(50)] + [(2, "another"), (3, "third")]
    labels = [(1, 1), (1, 1), (2, 0), (2, 0), (3, 1)]
    held = []
    monkeypatch.setattr(toxicity, "learn", lambda found, bounds, label, **_: held.append((len(bounds) - 1, list(label))))
    toxicity.fit(spark.createDataFrame(docs, "doc_id bigint, text string"),
                 spark.createDataFrame(labels, "doc_id bigint, toxic int"), "toxic")
    assert held == [(3, [1, 0, 1])]


def plain_nearest(ids, vectors, asked, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in asked:
        i = list(ids).index(q)
        score = unit @ unit[i]
        out[q] = [ids[j] for j in sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-round(score[j], 12), ids[j]))[:k]]
    return out


def test_index_recall(spark):
    table = queries.table(spark, "/root/testdata/sf0.1", "embeddings")
    got = queries.op6_permutation_index(spark, "/root/testdata/sf0.1").collect()
    rows = table.collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = plain_nearest(ids, vectors, [i for i in ids if i % 50 == 0], 5)
    found = {q: [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] for q in want}
    assert all(len(f) == 5 for f in found.values())
    assert np.mean([len(set(found[q]) & set(want[q])) / 5 for q in want]) >= 0.9
    unit = {i: v / np.linalg.norm(v) for i, v in zip(ids, vectors)}
    assert all(abs(r.score - unit[r.query_id] @ unit[r.vec_id]) < 1e-12 for r in got)


def test_index_on_odd_input(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)], i) for i in range(60)]
    rows += [(100 + i, rows[0][1], 0) for i in range(30)] + [(300, [1e200] * 8, 0), (301, [-1e-200] * 8, 0)]
    bad = [(400, None, 0), (401, [0.0] * 8, 0), (402, [float("nan")] * 8, 0), (403, [float("inf")] + [1.0] * 7, 0),
           (404, [None] + [1.0] * 7, 0), (405, [1.0, 2.0], 0), (None, rows[1][1], 0), (406, [], 0)]
    table = spark.createDataFrame(rows + bad + rows[:3], "vec_id bigint, embedding array<double>, rank int")
    got = permutation_index.nearest(table, F.col("vec_id") % 10 == 0, 5,
                                    settings=permutation_index.Settings(rerank=1.0, posts=8, probes=60, block=16)).collect()
    ids = [r[0] for r in rows]
    vectors = np.array([np.array(r[1]) / np.abs(r[1]).max() for r in rows])
    want = plain_nearest(ids, vectors, [i for i in ids if i % 10 == 0], 5)
    assert {q: [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
            for q in want} == want and len(got) == 5 * len(want)
    few = permutation_index.nearest(table.filter("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert permutation_index.nearest(table.limit(0), F.lit(True)).count() == 0


def test_hilbert_curve():
    """Every point once, each next to the one before."""
    for dimensions, bits in ((2, 5), (3, 3), (4, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
        key = packing.hilbert_key(points, bits)
        assert sorted(key) == list(range(len(points)))
        assert (np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def check_pieces(texts, pieces, sequence=1024):
    """Every document whole, every sequence gapless; returns the padding."""
    from tokenizers import Tokenizer

    definition = Tokenizer.from_file(queries.encoder().tokenizer)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
        assert p.length * 4 == len(p.ids) and 0 < p.length <= sequence
    for key, text in texts:
        ids = np.array([*definition.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[key], key=lambda p: p.start)
        assert b"".join(p.ids for p in own) == ids.tobytes()
        assert [p.start for p in own] == list(itertools.accumulate([0, *[p.length for p in own]]))[:-1]
        assert {p.doc_tokens for p in own} == {len(ids)}
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == list(itertools.accumulate([0, *[p.length for p in own]]))[:-1]
        assert sum(p.length for p in own) <= sequence
    return len(by_sequence) * sequence - sum(p.length for p in pieces)


def test_packing_round_trip(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame([(10**6, "a <|endoftext|> b <|x|>"), (10**6 + 1, ""), (10**6 + 2, None)], "doc_id bigint, text string"))
    pieces = packing.pack(docs, queries.encoder(), range_bytes=1 << 20).collect()
    padding = check_pieces([(r.doc_id, r.text) for r in docs.collect()], pieces)
    assert padding < 6 * 1024
    odd = packing.pack(odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), queries.encoder()).collect()
    check_pieces([(r.doc_id, r.text) for r in odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).collect()], odd)
    assert packing.pack(odd_docs, queries.encoder()).filter("start = 0").count() == odd_docs.count()
    assert packing.pack(no_docs, queries.encoder()).count() == 0


def test_encoders_agree_on_every_character():
    """The fast encoder splits and merges as the defining one does, for all characters."""
    from tokenizers import Tokenizer

    encoder = queries.encoder()
    definition = Tokenizer.from_file(encoder.tokenizer)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1 {chr(c)}{chr(c)} !{chr(c)}" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    different = [t for t in texts if definition.encode(t, add_special_tokens=False).ids != encoder.ids(t)]
    assert not different, [hex(ord(c)) for c in different[0][:8]]


def test_words_and_hashes():
    texts = ["One two,THREE", None, "", "été 42", "a b c d e f", " ".join("w%d" % (i % 7) for i in range(50))]
    chunk, = chunks(pa.array(texts))
    starts, ends, bounds = chunk.words(ALNUM)
    words = [bytes(chunk.data[a:b]).decode() for a, b in zip(starts, ends)]
    assert words[:5] == ["one", "two", "three", "été", "42"] and list(np.diff(bounds)) == [3, 0, 0, 2, 6, 50]
    assert all(hash_of(w.encode()) == h for w, h in zip(words, chunk.hashes(starts, ends)))
    starts, ends, bounds = chunk.words(VISIBLE)
    grams, text = ngrams(chunk.hashes(starts, ends), bounds, 5)
    assert list(np.bincount(text, minlength=6)) == [1, 0, 0, 1, 2, 46] and len(set(grams[text == 5])) == 7
    assert [c.first for c in chunks(pa.array(["x" * 50] * 4), limit=60)] == [0, 1, 2, 3]
