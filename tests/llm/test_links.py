"""Similarity join, decontamination and quotation linking against plain versions and on odd input."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard_join, queries, quotes
from millrace.llm.components import components

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=5):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def plain_components(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return sorted((key, len(s), least[find(i)]) for i, ((key, _), s) in enumerate(zip(rows, sets)))


def made_texts(seed):
    """Short texts over few words, chains of edits, a passage many share, and a large group of near copies."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 400)}"
    passage = " ".join(word() for _ in range(60))
    texts = [" ".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(120)]
    for _ in range(60):
        texts.append(" ".join([word() for _ in range(rng.randint(20, 80))]) + " " + passage)
    for size in (12, 40, 150, 700):
        text = [word() for _ in range(size)]
        for _ in range(25):
            texts.append(" ".join(text))
            text = list(text)
            for _ in range(rng.randint(0, max(1, size // 60))):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.4:
                text = text + [word() for _ in range(rng.randint(0, size // 8))]
    base = [word() for _ in range(90)]
    for _ in range(80):
        near = list(base)
        for _ in range(rng.randint(0, 2)):
            near[rng.randrange(90)] = word()
        texts.append(" ".join(near))
    texts += rng.choices(texts, k=40)
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, percent", [(1, 80), (2, 60)])
def test_join_against_all_pairs(spark, seed, percent):
    rows = made_texts(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = jaccard_join.similar_documents(docs, percent=percent)
    assert sorted(map(tuple, got.collect())) == plain_components(rows, percent)


def test_deletion_neighbourhood_stands_in_for_empty_segments():
    """Where only few segments are filled, a match may show in a one-deletion neighbourhood alone."""
    bands = jaccard_join.Bands.up_to(50, 80)
    scheme = jaccard_join.Scheme(bands, 0, frozenset(range(20)))
    left = np.arange(1, 31, dtype=np.uint64)
    right = np.append(left, np.uint64(99))
    whole, near = [], []
    for elements in (left, right):
        _, _, signature, _, deleted = scheme.postings(elements, np.zeros(len(elements), int), np.array([len(elements)]), 0)
        whole.append(set(signature[~deleted]))
        near.append(set(signature[deleted]))
    assert bands.band(np.array([30]))[0] == bands.band(np.array([31]))[0]
    changed = whole[0] - whole[1]
    assert all(s in near[1] or len(whole[0]) < len(whole[1]) for s in changed) and whole[0] & whole[1]


def test_join_on_odd_input(spark, odd_docs, no_docs):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.similar_documents(odd_docs).collect()}
    assert {(2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 3, 5), (6, 1, 6), (7, 1, 6), (9, 1, 9), (None, 1, None), (None, 0, None)} <= got
    assert jaccard_join.similar_documents(no_docs).count() == 0
    kept = jaccard_join.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 6, 8, 9, None, None], key=str)


def test_components(spark):
    edges = [(1, 2), (3, 2), (4, 3), (10, 11), (12, 11), (12, 12), (2, 1)] + [(100 + i, 101 + i) for i in range(40)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).select("node", "comp").collect()))
    assert got == {2: 1, 3: 1, 4: 1, 11: 10, 12: 10, **{101 + i: 100 for i in range(40)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_contamination(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(UPPER))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for key, text in docs:
        w = WORD.findall((text or "").translate(UPPER))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((key, len(w), len(hit), sorted(map(str, found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination_against_plain_version(spark, odd_docs, no_docs):
    rng = random.Random(3)
    words = lambda k: [rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(k)]
    items = [(i, " ".join(words(rng.choice([1, 2, 5, 12, 13, 14, 30])))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "..."), (103, items[3][1].upper()), (None, " ".join(words(20)))]
    docs = []
    for i in range(300):
        text = words(rng.randint(0, 120))
        for _ in range(rng.randint(0, 2)):
            source = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(source) - 13))
            at = rng.randint(0, len(text))
            text[at:at] = source[a:a + rng.choice([12, 13, 14, 99])]
        docs.append((i, rng.choice([" ", "-", "\n"]).join(text)))
    docs += docs[:5] + [(r.doc_id, r.text) for r in odd_docs.collect()]
    schema = "doc_id bigint, text string"
    got = decontaminate.contamination(spark.createDataFrame(docs, schema), spark.createDataFrame(
        items, "item_id bigint, text string"))
    named = sorted(((r.doc_id, r.n_words, r.n_hit, sorted(str(i) for i in r["items"] or []), r.contaminated)
                    for r in got.collect()), key=str)
    want = [(k, n, h, sorted(str(i) for i in f if i != "None"), c) for k, n, h, f, c in plain_contamination(docs, items)]
    assert [(x[:3], x[4]) for x in named] == [(x[:3], x[4]) for x in want]
    assert [x[3] for x in named] == [x[3] for x in want]
    one = spark.createDataFrame(items[:40], "item_id bigint, text string")
    assert decontaminate.contamination(no_docs, one).count() == 0
    none = decontaminate.contamination(odd_docs, one.limit(0)).collect()
    assert len(none) == odd_docs.count() and not any(r.contaminated for r in none)
    left = decontaminate.without_contaminated(odd_docs, one)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count()


def test_decontamination_is_native(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = decontaminate.contamination(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_quotes(spark):
    rows = [(1, "Hello there\nsecond line", 1), (2, "> Hello there\nI agree", 2), (3, ">> hello   THERE\n> I agree\nMe too", 3),
            (4, "> > Hello there\n> unknown words\nlate", 4), (5, None, 5), (6, "", 6), (7, "Hello there", 7),
            (8, ">Hello there\n>second line\nquotes two", 8), (2, "> Hello there\nI agree", 2), (None, "x\n> y", 1),
            (9, "> quotes two\r\n>> I agree\r\nends", 9), (10, "> not yet\nearly", 0), (11, "not yet", 11)]
    mail = spark.createDataFrame(rows, "message_id bigint, text string, sent int")
    got = {r.message_id: r for r in quotes.conversations(mail, sent="sent").collect()}
    parents = {k: r.parent_id for k, r in got.items() if k}
    assert parents == {1: None, 2: 1, 3: 2, 4: 1, 5: None, 6: None, 7: None, 8: 1, 9: 8, 10: None, 11: None}
    assert {k: (r.root_id, r.depth, r.position) for k, r in got.items() if r.root_id == 1} == {
        1: (1, 0, 1), 2: (1, 1, 2), 4: (1, 1, 3), 8: (1, 1, 4), 3: (1, 2, 5), 9: (1, 2, 6)}
    assert got[3].body == "Me too" and got[9].body == "ends" and got[5].body == "" and got[None].body == "x"
    assert quotes.conversations(mail.limit(0)).count() == 0


def test_quotes_in_copied_conversations(spark):
    """Every copy of a conversation keeps its own links, and a common line does not draw replies elsewhere."""
    turns = ["How do I\nopen this?\nThanks", "Turn the key\nThanks", "Yes\nThanks", "Good\nBye"]
    rows, want = [(1, "Thanks\nBye")], {1: None}
    for copy in range(1, 6):
        for i, text in enumerate(turns):
            key = copy * 10 + i
            marked = "".join(f"> {line}\n" for line in turns[i - 1].split("\n")) if i else ""
            rows.append((key, marked + text))
            want[key] = key - 1 if i else None
    # "Thanks" and "Yes" stand nearest in others, together last in 52; 103 quotes a part of 50
    rows += [(100, "Yes"), (101, "Thanks"), (102, "> Yes\n> Thanks\nreply"), (103, "> open this?\n> Thanks\nand I"),
             (104, "Thanks"), (105, "> Yes\nfoo\n> Thanks")]
    want |= {100: None, 101: None, 102: 52, 103: 50, 104: None, 105: 104}
    mail = spark.createDataFrame(rows, "message_id bigint, text string").repartition(3)
    got = {r.message_id: r for r in quotes.conversations(mail).collect()}
    assert {k: r.parent_id for k, r in got.items()} == want
    assert all(got[c * 10 + i].root_id == c * 10 and got[c * 10 + i].depth == i for c in range(1, 6) for i in range(4))


def test_nearest_author_across_stretches(spark, monkeypatch):
    monkeypatch.setattr(quotes, "STRETCH", 3)
    rows = [(i, "same line" if i % 7 == 0 else "> same line\nnew %d" % i) for i in range(40)]
    mail = spark.createDataFrame(rows, "message_id bigint, text string")
    got = {r.message_id: r.parent_id for r in quotes.conversations(mail).collect()}
    assert got == {i: None if i % 7 == 0 else i - i % 7 for i in range(40)}


def test_long_conversations_and_repeated_turns(spark):
    """Turns from 100000 on do not run into the next conversation, and repeated turns are all kept."""
    rows = [(1, 99_999, "a1"), (1, 100_000, "a2"), (1, 100_001, "a3"), (2, 0, "b1"), (2, 1, "b2"), (3, 0, "c1"),
            (3, 1, "c3"), (3, 1, "c2"), (3, 1, "c2"), (3, 2, "c4"), (None, 1, "d"), (1 << 60, 0, "e1"), (1 << 60, 1, None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string").repartition(3)
    got = queries.linked_turns(turns).collect()
    assert sorted(r.body for r in got) == sorted(t or "" for _, _, t in rows)
    ids = [r.message_id for r in got if r.message_id is not None]
    assert len(set(ids)) == len(ids) == len(rows) - 1
    body = {r.message_id: r.body for r in got}
    links = sorted((r.body, body[r.parent_id] if r.parent_id is not None else "") for r in got)
    assert links == sorted([("a1", ""), ("a2", "a1"), ("a3", "a2"), ("b1", ""), ("b2", "b1"), ("c1", ""), ("c3", "c1"),
                            ("c2", "c1"), ("c2", "c1"), ("c4", "c2"), ("d", ""), ("e1", ""), ("", "e1")])
    assert {r.body: r.message_id for r in got if r.body in ("a1", "b2", "c1", "c4")} == {
        "a1": 199_999, "b2": 200_001, "c1": 300_000, "c4": 300_002}


def test_one_of_each_with_clashing_and_missing_keys(spark):
    words = lambda x, n=30: " ".join(f"{x}{i}" for i in range(n))
    rows = [(1, words("a")), (1, words("b")), (2, words("b") + " more"), (None, words("a")), (None, words("c")),
            (None, words("c")), (None, words("d")), (4, words("d")), (5, words("e")), (5, words("e")), (6, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = jaccard_join.one_of_each(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        (1, words("a")), (1, words("b")), (None, words("c")), (4, words("d")), (5, words("e")), (6, ""), (6, None)], key=str)


def test_long_lines_are_parsed(spark):
    """Very many marks or blanks end neither the job nor the day."""
    texts = [(1, "> " * 100_000 + "deep"), (2, "a" + " " * 1_000_000 + "b"), (3, " \t> >x\n>\t y\n  plain \n>"), (4, None)]
    rows = spark.createDataFrame(texts, "n int, text string").select("n", quotes.parsed_lines(F.col("text")).alias("p"))
    got = {r.n: [tuple(x) for x in r.p] for r in rows.filter("n > 2").collect()}
    assert got == {3: [(2, "x"), (1, " y"), (0, " plain "), (1, "")], 4: [(0, "")]}
    assert rows.filter("n = 1").select("p.depth").first()[0] == [100_000]
    assert rows.filter("n = 1").select("p.line").first()[0] == ["deep"]
    assert rows.filter("n = 2").select(F.length(quotes.own_text(F.col("p")))).first()[0] == 1_000_002


def test_sets_without_a_proof_are_compared_by_elements(spark, monkeypatch):
    """With one segment a band hardly any set can prove that it differs: links must come all the same."""
    monkeypatch.setattr(jaccard_join.Bands, "segments", lambda self: np.full(len(self.edges) - 1, 1, np.uint64))
    rows = [(i, " ".join(f"w{j + (40 if j == i % 7 else 0)}" for j in range(30 + i % 3))) for i in range(40)]
    rows += [(100 + i, f"other words number {i} of no likeness at all") for i in range(6)]
    got = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, got.collect())) == plain_components(rows)


def test_a_hot_group_of_copies(spark):
    """A third of all rows are one text, another third differ from it in a word."""
    base = [f"t{j}" for j in range(60)]
    near = lambda i: " ".join([*base[:59], f"u{i}"])
    rows = ([(i, " ".join(base)) for i in range(400)] + [(400 + i, near(i)) for i in range(400)]
            + [(800 + i, " ".join(f"v{i}_{j}" for j in range(20))) for i in range(400)])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_documents(docs).collect()}
    assert all(got[i] == 0 for i in range(800)) and all(got[i] == i for i in range(800, 1200))


def test_a_group_is_asked_once_whatever_its_size(spark, monkeypatch):
    """Sets left outside a group of near copies are verified against a few of its members, not against all of them."""
    base = [f"t{j}" for j in range(120)]
    near = lambda i, end: " ".join(f"u{i}" if j == i else end if j == 119 else w for j, w in enumerate(base))
    rows = [(0, " ".join(base))] + [(i, near(5 + 2 * i, "t119")) for i in range(1, 41)] + [(50 + i, near(6 + 9 * i, f"e{i}")) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    nodes = [r.node for r in jaccard_join._read_sets(docs.filter("doc_id < 50"), 5).collect()]
    inside = spark.createDataFrame([(nodes[0], n) for n in nodes[1:]], "a bigint, b bigint")
    verified, counts = jaccard_join._verified, []

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", 1)
    monkeypatch.setattr(jaccard_join, "_star_pairs", lambda mixed, attempt: inside)
    monkeypatch.setattr(jaccard_join, "_verified", counted)
    got = jaccard_join.similar_documents(docs)
    assert sorted(map(tuple, got.collect())) == plain_components(rows)
    assert counts[0] == 40 and sum(counts[1:]) <= 8 * jaccard_join.STAR_PAIRS + 8 * 7 / 2


@pytest.mark.parametrize("postings, shares", [(0, 8), (7, 8), (600_000, 8), (300_000, 900)])
def test_postings_travel_in_small_batches(postings, shares):
    """A flush of postings is one set of rows, however many batches bring them: none is larger than a batch may be."""
    rng = np.random.default_rng(3)
    signature = rng.integers(0, 2**63, postings).astype(np.uint64)
    node, code = rng.integers(-2**62, 2**62, postings), rng.integers(0, 8, postings).astype(np.uint8)
    half = postings // 2
    batches = list(jaccard_join._packed([(signature[:half], node[:half], code[:half]), (signature[half:], node[half:], code[half:])], shares))
    assert all(b.nbytes <= 1 << 20 for b in batches)
    rows = [r for b in batches for r in b.to_pylist()]
    assert all(0 < len(r["code"]) <= jaccard_join.ROW_POSTINGS for r in rows)
    got = sorted((r["share"], int(s), int(n), int(c)) for r in rows for s, n, c in zip(
        np.frombuffer(r["signature"], np.uint32), np.frombuffer(r["node"], np.int64), np.frombuffer(r["code"], np.uint8)))
    assert got == sorted(zip((signature % np.uint64(shares)).astype(int).tolist(), (signature >> np.uint64(32)).astype(int).tolist(),
                             node.tolist(), code.tolist()))
