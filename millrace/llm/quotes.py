"""Quotation linking: conversations rebuilt from the passages that messages quote.

Quoted lines are told by their leading ``>`` signs, one for each level. Lines are normalised and hashed, alone,
in runs and as whole blocks; each quoted passage comes from the nearest earlier message that wrote it itself. A
message answers the message from which it quotes most at its shallowest level. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.keys import number_rows
from millrace.session import staged

STRETCH = 4096  # messages
_BLANKS = " \t\n\x0b\f\r"


def _parsed(line: Column) -> Column:
    # One run of blanks and marks; its last mark ends the marks. No pattern here repeats a group or looks back.
    lead = F.rtrim(F.regexp_extract(line, r"^[ \t>]*+", 0), F.lit(" \t"))
    depth = F.length(lead) - F.length(F.replace(lead, F.lit(">"), F.lit("")))
    return F.struct(depth.alias("depth"), F.regexp_replace(F.substr(line, F.length(lead) + 1), "^[ \t]", "").alias("line"))


def parsed_lines(text: Column) -> Column:
    """Lines of a text as (depth, line): the number of quote marks, and what follows them."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), _parsed)


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"\s+", " "))


def own_text(lines: Column) -> Column:
    """The lines without quote marks, blank lines at both ends taken off."""
    own = F.transform(F.filter(lines, lambda p: p["depth"] == 0), lambda p: p["line"])
    return F.trim(F.array_join(own, "\n"), F.lit(_BLANKS))


def _passages(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """``n, depth, hash, start, end`` of every passage: each line, each run of 2, 4, 8, ... lines at one
    depth, and each whole block of lines at one depth. Blank lines neither count nor part a block; ``start``
    and ``end`` count the characters of the message's lines."""
    digest = lambda *parts: F.unhex(F.md5(F.concat(*parts)))
    lines = (rows.select("id", F.posexplode("lines").alias("pos", "p"))
             .select("id", "pos", "p.depth", normalised(F.col("p.line")).alias("line")).filter(F.col("line") != "")
             .select("id", "pos", "depth", digest(F.col("line").cast("binary")).alias("h1"), F.length("line").alias("size")))
    order, block = Window.partitionBy("id").orderBy("pos"), Window.partitionBy("id", "block")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grams = (lines.join(numbers, "id")
             .withColumn("new", F.coalesce(F.lag("depth").over(order) != F.col("depth"), F.lit(True)).cast("int"))
             .withColumn("block", F.sum("new").over(so_far)).withColumn("e1", F.sum("size").over(so_far))
             .withColumn("start", F.col("e1") - F.col("size")))
    most = rows.agg(F.max(F.size("lines"))).first()[0] or 1
    widths = [1 << i for i in range(most.bit_length())]
    for half, width in zip(widths, widths[1:]):
        inside = F.lead("block", width - 1).over(order) == F.col("block")
        grams = (grams.withColumn(f"h{width}", F.when(inside, digest(f"h{half}", F.lead(f"h{half}", half).over(order))))
                 .withColumn(f"e{width}", F.lead("e1", width - 1).over(order)))
    # A block is told by its length and the two longest runs at its ends, which overlap or meet.
    grams = (grams.withColumn("top", F.coalesce(*[F.col(f"h{w}") for w in reversed(widths)]))
             .withColumn("k", F.count(F.lit(1)).over(block)).withColumn("r", F.row_number().over(block.orderBy("pos")))
             .withColumn("w", F.expr("1L << (length(bin(k)) - 1)")).withColumn("e", F.max("e1").over(block))
             .withColumn("tail", F.max(F.when(F.col("k") - F.col("r") + 1 == F.col("w"), F.col("top"))).over(block)))
    whole = F.when((F.col("r") == 1) & (F.col("k") > F.col("w")),
                   digest("top", "tail", F.col("k").cast("string").cast("binary")))
    found = [F.struct(F.col(f"h{w}").alias("hash"), F.col(f"e{w}").alias("end")) for w in widths]
    return (grams.select("n", "depth", "start", F.explode(F.array(*found, F.struct(whole.alias("hash"), F.col("e").alias("end")))).alias("g"))
            .filter("g.hash is not null").select("n", "depth", "g.hash", "start", "g.end"))


def _nearest_authors(passages: DataFrame) -> DataFrame:
    """``n, depth, start, end, author`` of quoted passages, ``author`` being the last message before that wrote
    the passage itself. Messages are dealt by passage and stretch of ``STRETCH`` messages, so a passage
    that very many write or quote fills no task; what came before a stretch is one row for each."""
    own, stretch = F.when(F.col("depth") == 0, F.col("n")), F.expr(f"(n - 1) div {STRETCH}")
    order = Window.partitionBy("hash", "stretch").orderBy("n", F.col("depth") == 0)
    near = staged(passages.withColumn("stretch", stretch)
                  .withColumn("near", F.last(own, True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                  .withColumn("ends", F.lead("n").over(order).isNull())
                  .filter("depth > 0 or ends")
                  .withColumn("hash", F.when(F.col("near").isNull() | F.col("ends"), F.col("hash"))), "passages")
    quoted = near.filter("depth > 0")
    earlier = Window.partitionBy("hash").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = (near.filter("ends").select("hash", "stretch", F.last("near", True).over(earlier).alias("author"))
              .filter("author is not null"))
    found = ["n", "depth", "start", "end", "author"]
    return (quoted.filter("near is not null").withColumnRenamed("near", "author").select(found)
            .unionByName(quoted.filter("near is null").join(before, ["hash", "stretch"]).select(found)))


def reply_links(messages: DataFrame, key: str = "message_id", text: str = "text", sent: str | None = None) -> DataFrame:
    """``id, sent, parent, body`` of every different key that is not null.

    Of rows that repeat a key the first by time and text counts. ``sent`` orders messages, then the key; a
    null time counts as the earliest. A quoted passage comes from the nearest earlier message that wrote
    it, and only earlier messages can be answered. Equal shares of quoted characters: the nearest message.
    """
    when = F.col(sent) if sent else F.lit(0)
    rows = (messages.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("id"))
            .agg(F.min(F.struct(when.alias("sent"), F.col(text).alias("text"))).alias("m"))
            .select("id", "m.sent", parsed_lines(F.col("m.text")).alias("lines")))
    rows = staged(rows, "messages")
    numbers = staged(number_rows(rows.select("sent", "id"), ["sent", "id"], "n").select("id", "n"), "message-numbers")
    quoted = _nearest_authors(_passages(rows, numbers))
    # Passages overlap: characters count once for an author.
    before = (Window.partitionBy("n", "depth", "author").orderBy("start", "end")
              .rowsBetween(Window.unboundedPreceding, -1))
    gain = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("reached", "start")))
    parents = (quoted.withColumn("reached", F.max("end").over(before)).groupBy("n", "depth", "author")
               .agg(F.sum(gain).alias("size")).groupBy("n")
               .agg(F.min_by("author", F.struct("depth", -F.col("size"), -F.col("author"))).alias("author"))
               .join(numbers, "n").select(F.col("id"), "author")
               .join(numbers.select(F.col("id").alias("parent"), F.col("n").alias("author")), "author").select("id", "parent"))
    return rows.join(parents, "id", "left").select("id", "sent", "parent", own_text(F.col("lines")).alias("body"))


def _ancestors(links: DataFrame) -> DataFrame:
    """``id, root, depth`` by doubling the reach of every message's pointer: as many rounds as the
    logarithm of the deepest thread."""
    reach = staged(links.select("id", F.coalesce("parent", "id").alias("root"),
                                F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth")), "threads")
    while True:
        above = reach.select(F.col("id").alias("root"), F.col("root").alias("up"), F.col("depth").alias("more"))
        longer = staged(reach.join(above, "root").select(
            "id", F.col("up").alias("root"), (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("up") != F.col("root")).alias("moved")), "threads")
        reach = longer.drop("moved")
        if longer.filter("moved").isEmpty():
            return reach


def conversations(messages: DataFrame, key: str = "message_id", text: str = "text",
                  sent: str | None = None) -> DataFrame:
    """Messages as reply-ordered conversations without quotes: ``key, parent_id, root_id, depth, position,
    body``.

    ``position`` counts from 1 within a conversation: answers come after what they answer, levels in turn,
    then by time and key. A null or empty text has an empty body and answers nothing. Rows with a null
    key cannot be answered or ordered: they come back with their body alone, other columns null.
    """
    links = staged(reply_links(messages, key, text, sent), "replies")
    placed = links.join(_ancestors(links), "id")
    numbered = staged(number_rows(placed, ["root", "depth", "sent", "id"], "row"), "ordered-replies")
    first = numbered.groupBy("root").agg(F.min("row").alias("first"))
    out = numbered.join(first, "root").select(
        F.col("id").alias(key), F.col("parent").alias("parent_id"), F.col("root").alias("root_id"), "depth",
        (F.col("row") - F.col("first") + 1).alias("position"), "body")
    nameless = messages.filter(F.col(key).isNull()).select(key, own_text(parsed_lines(F.col(text))).alias("body"))
    return out.unionByName(nameless, allowMissingColumns=True)
