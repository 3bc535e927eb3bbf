"""The corpus pipeline stage by stage against plain versions, and all registered corpus queries."""

import os

import pytest
from oracle import compare, connect
from test_links import plain_components, plain_contamination
from test_models import check_pieces
from test_scans import plain_secrets

import corpus_pipeline
from millrace.llm import packing, quality, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    query, sql = queries.QUERIES[name]
    assert compare(spark, SF, query, sql, connect(SF)) == []


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert [n for n in range(1, 14) if not any(x.startswith(f"op{n}_") for x in names)] == []


def test_stages(spark):
    docs = queries.table(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        kept[name] = docs.collect()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(kept[name], docs.schema)
    everything = {r.doc_id: r for r in queries.table(spark, SF, "documents").collect()}
    scores = {r.doc_id: r.predicted for r in queries.op3_quadratic_discriminant(spark, SF).collect()}
    assert {r.doc_id for r in kept["quality"]} == {k for k, p in scores.items() if p}
    first = {c for _, _, c in plain_components([(r.doc_id, r.text) for r in kept["quality"]])}
    assert {r.doc_id for r in kept["similar"]} == first
    items = [tuple(r) for r in queries.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    clean = {k for k, _, _, _, bad in plain_contamination([(r.doc_id, r.text) for r in kept["similar"]], items) if not bad}
    assert {r.doc_id for r in kept["benchmark"]} == clean and len(clean) < len(first)
    assert {r.doc_id for r in kept["secrets"]} == clean
    for r in kept["secrets"]:
        old = everything[r.doc_id].text or ""
        assert (r.text == old) == (not plain_secrets(old)) and not plain_secrets(r.text)
        assert r.text == old or r.n_chars == len(r.text)
    pieces = packing.pack(docs, queries.encoder()).collect()
    check_pieces([(r.doc_id, r.text) for r in kept["secrets"]], pieces)
    want = {(r.doc_id, r.start, r.length) for r in pieces}
    got = corpus_pipeline.run(spark, SF)
    assert {(r.doc_id, r.start, r.length) for r in got.collect()} == want
    assert set(got.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def test_stages_on_odd_input(spark, odd_docs, no_docs):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd_docs.select(names), no_docs.select(names)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.filter("length is null or offset is null").count() == 0
