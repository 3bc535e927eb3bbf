"""URL filter rules found through their rarest literal token.

Rules are written in the usual filter-list notation: ``||`` binds the pattern to the start of the
host or of any of its labels, ``*`` stands for any text, everything else is literal. A rule is filed
under the literal token that is rarest among the URLs at hand; the tokens of a URL fetch their
rules, and only those run their regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 100_000  # rules are sent to every executor; a longer list is refused, not cut
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = "[0-9a-z-]+"


@dataclass(frozen=True)
class Rule:
    """``listed`` rules compete by length and name the row's ``rule``; the others only decide where
    no listed rule fits, and there any ``block`` wins."""

    name: str
    pattern: str
    verdict: str
    listed: bool = True

    def regex(self) -> str:
        anchored = self.pattern.startswith("||")
        body = ".*".join(_quoted(p) for p in self.pattern.removeprefix("||").split("*"))
        return ("^([^/]*[.])?" if anchored else "") + body

    def tokens(self) -> list[str]:
        """Literal tokens that are whole tokens of every URL the rule fits."""
        text = self.pattern.removeprefix("||")
        found = []
        for m in re.finditer(_TOKEN, text.lower()):
            left = text[m.start() - 1] not in "*" if m.start() else self.pattern.startswith("||")
            right = m.end() < len(text) and text[m.end()] != "*"
            if left and right:
                found.append(m.group())
        return sorted(set(found)) or [""]


def _quoted(text: str) -> str:
    return re.sub(r"([^0-9A-Za-z/_-])", r"[\1]", text)


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host, its subdomains and the paths that start with ``path``."""
    return Rule(host + path, f"||{host}{path}", verdict)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null or a text without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(whole, pattern, 1), _UPPER, _LOWER),
            F.regexp_extract(whole, pattern, 2))


def judge_urls(urls: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``urls`` (its column ``url``, repeated and null values allowed) as one row per distinct URL,
    null counting as the empty text: ``url, host, path, rule, verdict``.

    No rule, no token, an empty table: verdict ``allow``, rule null. Of two listed rules of the same
    length the one with the smaller name wins.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are sent to executors")
    spark = urls.sparkSession
    host, path = url_parts(F.col("url"))
    each = (urls.select(F.coalesce(F.col(url), F.lit("")).alias("url")).distinct()
            .select("url", host.alias("host"), path.alias("path")))
    text = F.concat("host", "path")
    parts = F.split(F.translate(text, _UPPER, _LOWER), "[^0-9a-z-]+")
    tokens = each.select("url", text.alias("_text"), F.explode(
        F.array_distinct(F.concat(F.array(F.lit("")), F.coalesce(parts, F.array())))).alias("token"))

    filed = spark.createDataFrame(
        [(i, t) for i, r in enumerate(rules) for t in r.tokens()], "id int, token string")
    seen = (tokens.join(F.broadcast(filed.select("token").distinct()), "token")
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    rarest = (filed.join(seen, "token", "left").groupBy("id")
              .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")))
    listing = spark.createDataFrame(
        [(i, r.name, r.regex(), r.verdict, r.listed) for i, r in enumerate(rules)],
        "id int, name string, regex string, says string, listed boolean")
    index = rarest.join(F.broadcast(listing), "id")

    hits = tokens.join(F.broadcast(index), "token").filter(F.expr("_text rlike regex"))
    rank = F.when(F.col("listed"), F.struct(-F.length("name"), F.col("name")))
    best = hits.groupBy("url").agg(
        F.min_by("name", rank).alias("rule"), F.min_by("says", rank).alias("listed_verdict"),
        F.max((~F.col("listed") & (F.col("says") == "block"))).alias("blocked"))
    return each.join(best, "url", "left").select(
        "url", "host", "path", "rule",
        F.coalesce("listed_verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))


def judge_pages(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """Every row of ``pages`` (repeated rows stay repeated): ``key, host, path, rule, verdict``."""
    rows = pages.select(F.col(key).alias("_key"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    return (rows.join(judge_urls(rows, rules), "url", "left")
            .select(F.col("_key").alias(key), "host", "path", "rule", "verdict"))


LISTED = (site_rule("com", "/", "allow"), site_rule("example.com", "/en/", "block"),
          site_rule("www.example.com", "/en/", "allow"), site_rule("net", "/es/", "block"),
          site_rule("net", "/fr/", "block"))
# Own rules: unwanted kinds of sites, wherever they are.
SPAM = tuple(Rule(p, p, "block", listed=False) for p in (
    "||casino-win.", "||casino.", "||poker.", "||adserver.", "||ads.", "||tracker.", "/wp-login.php",
    "/cgi-bin/", "/casino/", "/xxx/"))
