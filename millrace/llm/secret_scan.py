"""Secret scan: a keyword automaton finds places, anchored patterns run only there, checksums decide.

One pass of an Aho-Corasick automaton over the text, in lower case, gives every keyword's places.
The keyword's pattern is tried at those places alone. Tokens that carry a checksum must meet it.
Bare hexadecimal runs have no keyword: for them the run itself is the filter.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import over_texts

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_base62(body: str) -> str:
    """CRC-32 of ``body`` as six base-62 digits, as access tokens carry it at their end."""
    n, digits = binascii.crc32(body.encode()), ""
    for _ in range(6):
        n, rest = divmod(n, 62)
        digits = _BASE62[rest] + digits
    return digits


def has_checksum(match: re.Match) -> bool:
    body = match[0].split("_", 1)[1]
    return crc_base62(body[:-6]) == body[-6:]


def is_token_header(match: re.Match) -> bool:
    """Whether the first part of a dotted token decodes to a JSON object that names an algorithm."""
    head = match[0].split(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, TypeError):
        return False


@dataclass(frozen=True)
class Kind:
    """Keywords in lower case, the pattern tried where one stands (``back`` characters before it),
    and what a match has to meet."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: Callable[[re.Match], bool] = lambda match: True


# The base kinds.
BASE = (
    Kind("assign", ("password", "passwd", "secret", "token", "api_key", "apikey"),
         re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A), lambda m: len(m[2]) >= 12),
    Kind("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
)
HEX = "hex"
_HEX = re.compile(r"[0-9a-f]{16,}")
# Public token formats besides.
MORE = (
    Kind("code_host", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
         re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), has_checksum),
    Kind("registry", ("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), has_checksum),
    Kind("web_token", ("eyj",), re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"),
         is_token_header),
    Kind("chat", ("xoxb-", "xoxp-", "xoxa-", "xoxr-", "xoxs-"), re.compile(r"xox[baprs]-[0-9A-Za-z-]{20,}")),
    Kind("payment", ("sk_live_", "rk_live_"), re.compile(r"[sr]k_live_[0-9A-Za-z]{24,}")),
    Kind("maps", ("aiza",), re.compile(r"AIza[0-9A-Za-z_-]{35}")),
    Kind("private_key", ("-----begin",), re.compile(
        r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[\sA-Za-z0-9+/=:,-]*?-----END (?:[A-Z]+ )*PRIVATE KEY-----")),
)
KINDS = (*BASE, *MORE)
ORDER = ("assign", "access", HEX, *(k.name for k in MORE))


def lower_ascii(text: str) -> str:
    """A-Z in lower case; the length stays."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _automaton():
    import ahocorasick

    made = ahocorasick.Automaton()
    for kind in KINDS:
        for word in kind.keywords:
            made.add_word(word, (len(word), kind))
    made.make_automaton()
    return made


def find_secrets(text: str, automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, leftmost and not overlapping within a kind."""
    found = [(m.start(), m.end(), HEX) for m in _HEX.finditer(text)]
    places: dict[Kind, list[int]] = {}
    for last, (length, kind) in automaton.iter(lower_ascii(text)):
        places.setdefault(kind, []).append(last - length + 1)
    for kind, starts in places.items():
        free = 0
        for start in sorted(starts):
            if start >= free and (m := kind.pattern.match(text, start)):
                free = m.end()
                if kind.valid(m):
                    found.append((start, free, kind.name))
    return sorted(found, key=lambda s: (s[0], ORDER.index(s[2])))


def redact(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """``text`` with every span, or run of overlapping spans, replaced by ``mark``."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """One row per row of ``docs``: ``key``, ``spans`` (kind, start, end in code points, end
    exclusive, by start and kind) and ``clean``, the text with the spans replaced by ``mark``.

    A null text has no spans and stays null; an empty one stays empty. Whole texts are scanned;
    repeated rows are scanned each."""
    def work(column: pa.Array) -> list:
        automaton = _automaton()
        spans, cleaned = [], []
        for value in column.to_pylist():
            found = find_secrets(value, automaton) if value else []
            spans.append([{"kind": k, "start": a, "end": b} for a, b, k in found])
            cleaned.append(redact(value, found, mark) if found else value)
        return [pa.array(spans, pa.list_(_SPAN)), pa.array(cleaned, pa.string())]

    return over_texts(docs, key, text, "spans array<struct<kind:string,start:bigint,end:bigint>>, clean string", work)


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", length: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``, secrets in ``text`` replaced by ``mark``; the column ``length``, if
    named, becomes the number of characters of changed texts."""
    at, size_at = docs.columns.index(text), docs.columns.index(length) if length else -1

    def run(batches):
        for batch in batches:
            automaton = _automaton()
            columns = list(batch.columns)
            values, sizes = columns[at].to_pylist(), columns[size_at].to_pylist() if length else []
            for i, value in enumerate(values):
                if value and (found := find_secrets(value, automaton)):
                    values[i] = redact(value, found, mark)
                    if length:
                        sizes[i] = len(values[i])
            columns[at] = pa.array(values, columns[at].type)
            if length:
                columns[size_at] = pa.array(sizes, columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def secret_report(scan: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as text."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = ("assign", "access", HEX)
    only = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return scan.select(key, *[F.size(only(k)).cast("bigint").alias(f"n_{k}") for k in base],
                       F.sha2(joined(only(*base)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
