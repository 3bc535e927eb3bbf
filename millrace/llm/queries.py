"""Registered queries: each operator over its whole table, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import (ball_tree, decontaminate, jaccard_join, lexical, licenses, merkle, packing, permutation_index, quality,
                          quotes, secret_scan, toxicity, url_rules)
from millrace.operators.keys import number_rows
from millrace.session import staged


def table(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_license_templates(spark, sf):
    found = licenses.scan_licenses(table(spark, sf, "documents"), licenses.PHRASES, licenses.TEMPLATES)
    return licenses.license_report(found).drop("template_hits")


def mails(turns: DataFrame) -> DataFrame:
    """Conversation turns written as mails: each quotes the turn before it and, one level deeper, the one
    before that. Only their text tells which mail answers which.

    ``message_id`` is (conv_id, turn, row), another one for every row; null where conv_id or turn is. Of rows that
    repeat a turn all are mails, and the first by text is the one quoted.
    """
    rows = staged(number_rows(turns.select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text")),
                              ["conv_id", "turn", "text"], "row"), "turns")
    first = rows.groupBy("conv_id", "turn").agg(F.min(F.struct("row", "text")).alias("first"))
    ids = F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.struct("conv_id", "turn", "row"))
    marked = lambda marks, column: F.concat(F.lit(marks), F.replace(column, F.lit("\n"), F.lit("\n" + marks)), F.lit("\n"))
    before = lambda n: first.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("first.text").alias(f"back{n}"))
    return (rows.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
            .select(ids.alias("message_id"), F.concat(F.coalesce(marked(">> ", F.col("back2")), F.lit("")),
                                                      F.coalesce(marked("> ", F.col("back1")), F.lit("")), F.col("text")).alias("text")))


TURNS = 100_000


def mail_numbers(mails: DataFrame) -> DataFrame:
    """``message_id, number``, no number twice: conv_id * TURNS + turn where both fit, for the first row of
    a turn; below zero for other rows, which this number would mix up."""
    ids = mails.filter(F.col("message_id").isNotNull()).select("message_id", "message_id.*")
    first = ids.groupBy("conv_id", "turn").agg(F.min("row").alias("first"))
    fits = (F.col("conv_id").between(0, (1 << 63) // TURNS - 1) & F.col("turn").between(0, TURNS - 1)
            & (F.col("row") == F.col("first")))
    return ids.join(first, ["conv_id", "turn"]).select(
        "message_id", F.when(fits, F.col("conv_id") * TURNS + F.col("turn")).otherwise(-F.col("row")).alias("number"))


def op2_quotation_linking(spark, sf):
    return linked_turns(table(spark, sf, "conversations"))


def linked_turns(turns: DataFrame) -> DataFrame:
    """One row for every turn, ids as ``mail_numbers`` gives them."""
    written = staged(mails(turns), "mails")
    out, numbers = quotes.conversations(written), staged(mail_numbers(written), "mail-numbers")
    for name in ("message_id", "parent_id", "root_id"):
        named = numbers.select(F.col("message_id").alias(name), F.col("number").alias(f"{name}_"))
        out = out.join(named, name, "left").drop(name).withColumnRenamed(f"{name}_", name)
    return out.select("message_id", "parent_id", "root_id", "depth", "position", "body")


OP2_SQL = r"""
with recursive turns as (
    select conv_id, turn, conv_id * 100000 + turn as id, coalesce(text, '') as text from conversations),
line as (
    select id, unnest(string_split(text, chr(10))) as raw from turns),
clean as (
    select id, trim(regexp_replace(lower(raw), '\s+', ' ', 'g')) as line from line),
owner as (select line, min(id) as owner from clean where line <> '' group by line),
back as (
    select m.id, d.depth, c.line
    from turns m, (values (1), (2)) d(depth)
    join turns q on q.conv_id = m.conv_id and q.turn = m.turn - d.depth
    join clean c on c.id = q.id and c.line <> ''),
quoted as (
    select b.id, depth, owner, sum(length(b.line)) as size
    from back b join owner using (line) where owner < b.id group by all),
parent as (
    select id, arg_min(owner, {'d': depth, 's': -size, 'o': owner}) as parent_id from quoted group by id),
thread as (
    select id, id as root_id, 0 as depth from turns where id not in (select id from parent)
    union all
    select p.id, t.root_id, t.depth + 1 from thread t join parent p on p.parent_id = t.id)
select id as message_id, parent_id, root_id, depth,
       row_number() over (partition by root_id order by depth, id) as position,
       regexp_replace(text, '\A\s+|\s+\z', '', 'g') as body
from turns join thread using (id) left join parent using (id)"""


def scored(spark, sf, label: str, operator, threshold: float) -> DataFrame:
    """Scores of all documents by a model that learnt from the labels outside the held-out fold."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = operator.fit(docs, labels.filter(~quality.held_out(F.col("doc_id"))), label)
    return operator.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


QUALITY_THRESHOLD, TOXIC_THRESHOLD = 0.3, 0.5


def op3_quadratic_discriminant(spark, sf):
    return scored(spark, sf, "quality", quality, QUALITY_THRESHOLD)


def op4_factorization_machine(spark, sf):
    return scored(spark, sf, "toxic", toxicity, TOXIC_THRESHOLD)


def op5_secret_scan(spark, sf):
    return secret_scan.secret_report(secret_scan.scan_secrets(table(spark, sf, "documents")))


def op6_permutation_index(spark, sf):
    return permutation_index.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_decontamination(spark, sf):
    return decontaminate.report(decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


OP7_SQL = r"""
with tok as (
    select doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from documents),
item as (
    select item_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from benchmark),
win as (
    select distinct item_id, least(13, len(w)) as n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as g
    from (select *, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from item where len(w) > 0)),
size as (select distinct n from win),
place as (
    select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as g
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from tok, size where len(w) >= n)),
hit as (select doc_id, item_id, i, place.n from place join win on place.g = win.g and place.n = win.n),
word as (select doc_id, count(distinct j) as n_hit
         from (select doc_id, unnest(range(i, i + n)) as j from hit) group by doc_id),
named as (select doc_id, count(distinct item_id) as n_items,
                 string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as items
          from hit group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) as contaminated
from tok left join word using (doc_id) left join named using (doc_id)"""


def op8_url_rules(spark, sf):
    return url_rules.judge_pages(table(spark, sf, "pages"), url_rules.LISTED + url_rules.SPAM)


OP8_SQL = r"""
with part as (
    select page_id, lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)) as host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
    from pages),
rule(h, p, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
judged as (
    select *, (select max_by({'n': h || p, 'v': v}, length(h || p)) from rule
               where (host = h or ends_with(host, '.' || h)) and starts_with(path, p)) as hit
    from part)
select page_id, host, path, hit.n as rule,
       coalesce(hit.v, case when regexp_matches(host,
           '(^|[.])(casino-win|casino|poker|adserver|ads|tracker)[.]')
           or regexp_matches(host || path, '/wp-login[.]php|/cgi-bin/|/casino/|/xxx/')
           then 'block' else 'allow' end) as verdict
from judged"""

def op9_jaccard_join(spark, sf):
    return jaccard_join.similar_documents(table(spark, sf, "documents"))


OP9_SQL = r"""
with recursive word as (
    select doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from documents),
shingle as (
    select distinct doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') as s
    from (select *, unnest(range(1, len(w) - least(5, len(w)) + 2)) as i from word where len(w) > 0)),
size as (select doc_id, count(*) as n from shingle group by doc_id),
linked as (
    select x.doc_id as a, y.doc_id as b
    from (select l.doc_id as x, r.doc_id as y, count(*) as c
          from shingle l join shingle r on l.s = r.s and l.doc_id <> r.doc_id group by all) p
    join size x on x.doc_id = p.x join size y on y.doc_id = p.y
    where 100 * c >= 80 * (x.n + y.n - c)),
reach as (
    select doc_id as a, doc_id as b from documents
    union
    select reach.a, linked.b from reach join linked on reach.b = linked.a)
select d.doc_id, coalesce(n, 0) as n_shingles, (select min(b) from reach where a = d.doc_id) as component_id
from documents d left join size on size.doc_id = d.doc_id"""

TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def encoder() -> packing.Encoder:
    import public_tokenizers

    return packing.Encoder(public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op10_hilbert_packing(spark, sf):
    return packing.report(packing.pack(table(spark, sf, "documents"), encoder()))


def op11_lexical_search(spark, sf):
    return lexical.rank_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


OP11_SQL = r"""
with tok as (
    select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from documents),
whole as (select count(*) filter (len(w) > 0) as n_docs, sum(len(w))::bigint as n_terms from tok),
item as (
    select distinct item_id, unnest(list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) as t
    from benchmark where item_id is not null),
word as (select r, t, count(*) as tf from (select r, unnest(w) as t from tok) group by all),
weight as (
    select t, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight
    from word, whole where t in (select t from item) group by t, n_docs),
doc as (select r, doc_id, 100 - 50 + ((50 * len(w) * n_docs) // n_terms) as m from tok, whole),
scored as (
    select item_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
    from item join weight using (t) join word using (t) join doc using (r) group by all),
ranked as (
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as integer) as rank,
           doc_id, score
    from scored join doc using (r) where score > 0)
select * from ranked where rank <= 50"""


def lowered(text):
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def op12_merkle_manifest(spark, sf):
    return manifest_digest(table(spark, sf, "documents"))


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The manifest of documents by lang; in every third row, by the checksum of its id, the text was changed."""
    leaf = lambda text: merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    made = merkle.manifest(docs, "doc_id", "lang", leaf(F.col("text")), F.when(tampered, leaf(lowered(F.col("text")))))
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


OP12_SQL = r"""
with recursive doc as (
    select doc_id, coalesce('v' || lang, '') as g, text,
           concat(coalesce(octet_length(encode(doc_id::varchar)) || ':' || doc_id, '-'),
                  coalesce(octet_length(encode(source)) || ':' || source, '-'),
                  coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
                  coalesce(octet_length(encode(n_chars::varchar)) || ':' || n_chars, '-')) as head,
           xor(4294967295, list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
               lambda a, b: list_reduce([i::bigint for i in range(8)], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)),
               4294967295::bigint)) % 3 = 0 as tampered
    from documents),
leaf as (
    select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by g) as n
    from (select doc_id, g, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) as leaf,
                 case when tampered then sha256(head || coalesce(octet_length(encode(text)) || ':' || translate(text,
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) end as forged from doc)),
node as (
    select g, n, 0 as level, idx, leaf as d from leaf
    union all
    select g, any_value((n + 7) // 8), level + 1, idx // 8, sha256(string_agg(d, '' order by idx))
    from node where n > 1 group by g, level, idx // 8),
subroot as (select g, d, row_number() over (order by g) - 1 as idx, count(*) over () as n from node where n = 1),
top as (
    select n, 0 as level, idx, d from subroot
    union all
    select any_value((n + 7) // 8), level + 1, idx // 8, sha256(string_agg(d, '' order by idx))
    from top where n > 1 group by level, idx // 8),
every as (select g, n, level, idx, d from node union all select '~', n, level, idx, d from top),
side as (
    select a.g, a.level, a.idx, coalesce(string_agg(b.d, '' order by b.idx) filter (b.idx < a.idx), '') as before,
           coalesce(string_agg(b.d, '' order by b.idx) filter (b.idx > a.idx), '') as after
    from every a left join every b on a.g = b.g and a.level = b.level and a.idx // 8 = b.idx // 8 and a.idx <> b.idx
    where a.n > 1 group by all),
fold as (
    select doc_id, leaf, g, idx as place, 0 as level, idx, coalesce(forged, leaf) as d, '' as proof from leaf
    union all
    select doc_id, leaf, f.g, place, f.level + 1, f.idx // 8, sha256(before || d || after), proof || before || after
    from fold f join side s on f.g = s.g and f.level = s.level and f.idx = s.idx),
up as (
    select doc_id, leaf, s.d as subroot, f.g, place, 0 as level, s.idx, f.d, proof
    from (select *, max(level) over (partition by g) as last from fold) f join subroot s using (g) where f.level = last
    union all
    select doc_id, leaf, subroot, f.g, place, f.level + 1, f.idx // 8, sha256(before || d || after), proof || before || after
    from up f join side s on s.g = '~' and f.level = s.level and f.idx = s.idx)
select doc_id, leaf, subroot, (select d from top where n = 1) as root, sha256(proof) as proof_sha256,
       d as folded_root, d = (select d from top where n = 1) as verified
from up where level = (select max(level) from top)"""


def op13_ball_tree_search(spark, sf):
    return ball_tree.largest_products(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


OP13_SQL = r"""
with v as (
    select distinct vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
    from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
ranked as (
    select q.vec_id as query_id, v.vec_id, cast(list_inner_product(q.e, v.e) as bigint) as score,
           cast(row_number() over (partition by q.vec_id order by cast(list_inner_product(q.e, v.e) as bigint) desc, v.vec_id)
                as integer) as rank
    from v q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0)
select query_id, rank, vec_id, score from ranked where rank <= 5"""

QUERIES = {
    "op10_hilbert_packing": (op10_hilbert_packing, None),
    "op11_lexical_search": (op11_lexical_search, OP11_SQL),
    "op12_merkle_manifest": (op12_merkle_manifest, OP12_SQL),
    "op13_ball_tree_search": (op13_ball_tree_search, OP13_SQL),
    "op1_license_templates": (op1_license_templates, None),
    "op2_quotation_linking": (op2_quotation_linking, OP2_SQL),
    "op3_quadratic_discriminant": (op3_quadratic_discriminant, None),
    "op4_factorization_machine": (op4_factorization_machine, None),
    "op5_secret_scan": (op5_secret_scan, None),
    "op6_permutation_index": (op6_permutation_index, None),
    "op7_decontamination": (op7_decontamination, OP7_SQL),
    "op8_url_rules": (op8_url_rules, OP8_SQL),
    "op9_jaccard_join": (op9_jaccard_join, OP9_SQL),
}
