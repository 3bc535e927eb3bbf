"""License scan: notices and license texts as templates with optional and replaceable regions.

A template is wording with markup: ``<<optional>> .. <<end>>`` may be missing, ``<<words:0-12>>``
stands for that many words of any kind. It is compiled to an automaton over word hashes. The
automaton starts only at words with which a template can begin, and accepts only where every
mandatory word is met in order; the longest reading of a start counts.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import ALNUM, Chunk, chunks, hash_of, over_texts

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARK = re.compile(r"<<(optional|end|words:(\d+)-(\d+))>>")


@dataclass(frozen=True)
class Automaton:
    """Step ``i`` reads word hash ``word[i]`` (any word where ``free[i]``) and goes on to ``i + 1``;
    ``skips[i]`` are the steps reachable from ``i`` without reading a word, itself included."""

    word: tuple[int, ...]
    free: tuple[bool, ...]
    skips: tuple[tuple[int, ...], ...]

    @property
    def firsts(self) -> set[int]:
        return {self.word[i] for i in self.skips[0] if i < len(self.word)}

    def longest(self, hashes: np.ndarray, at: int, end: int) -> int:
        """End of the longest accepted run of words from ``at``; -1 if there is none."""
        done, states, found = len(self.word), set(self.skips[0]), -1
        while True:
            if done in states:
                found = at
            if at >= end or not states:
                return found
            read = int(hashes[at])
            states = {j for i in states if i < done and (self.free[i] or self.word[i] == read)
                      for j in self.skips[i + 1]}
            at += 1


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


def compile_template(template: str) -> Automaton:
    """The automaton of a template; it must begin with a mandatory or optional word and its optional
    regions do not nest."""
    word: list[int] = []
    free: list[bool] = []
    jumps: list[tuple[int, int]] = []
    opened, at = -1, 0
    for mark in [*_MARK.finditer(template), None]:
        plain = words_of(template[at:mark.start() if mark else len(template)])
        word += [int(hash_of(w)) for w in plain]
        free += [False] * len(plain)
        if mark is None:
            break
        at = mark.end()
        if mark[1] == "optional":
            if opened >= 0:
                raise ValueError("optional regions do not nest")
            opened = len(word)
        elif mark[1] == "end":
            jumps.append((opened, len(word)))
            opened = -1
        else:
            low, high = int(mark[2]), int(mark[3])
            last = len(word) + high
            jumps += [(i, last) for i in range(len(word) + low, last)]
            word += [0] * high
            free += [True] * high
    skips = [{i} for i in range(len(word) + 1)]
    for i in range(len(word), -1, -1):
        for a, b in jumps:
            if a == i:
                skips[i] |= skips[b]
    made = Automaton(tuple(word), tuple(free), tuple(tuple(sorted(s)) for s in skips))
    if len(word) in skips[0] or any(free[i] for i in skips[0]):
        raise ValueError("a template begins with a word of its own and has a mandatory one")
    return made


def _phrase_places(chunk_hashes: np.ndarray, text_of: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Word positions where the phrase's words stand one after the other in one text."""
    n = len(chunk_hashes) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    hit = text_of[:n] == text_of[len(phrase) - 1:]
    for i, h in enumerate(phrase):
        hit &= chunk_hashes[i:i + n] == np.uint64(h)
    return np.flatnonzero(hit)


def scan_licenses(docs: DataFrame, phrases: Mapping[str, str], templates: Mapping[str, str],
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_words``, ``phrase_hits`` (label, start) and
    ``template_hits`` (label, start, end), positions in words from 0, ordered by start and label.

    Phrases are ``{words: label}``, templates ``{label: template}``. A null or empty text has no
    words and no hits; overlapping hits all count; repeated rows are scanned each.
    """
    plain = [([int(hash_of(w)) for w in words_of(p)], label) for p, label in phrases.items()]
    automata = [(label, compile_template(t)) for label, t in templates.items()]
    by_first: dict[int, list[tuple[str, Automaton]]] = {}
    for label, automaton in automata:
        for first in automaton.firsts:
            by_first.setdefault(first, []).append((label, automaton))
    firsts = np.array(sorted(by_first), np.uint64)

    def scan(chunk: Chunk, counts: list, phrase_hits: list, template_hits: list) -> None:
        starts, ends, bounds = chunk.words(ALNUM)
        hashes = chunk.hashes(starts, ends)
        text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        counts.extend(np.diff(bounds).tolist())
        found: list[list] = [[] for _ in range(len(bounds) - 1)]
        accepted: list[list] = [[] for _ in range(len(bounds) - 1)]
        for words, label in plain:
            for at in _phrase_places(hashes, text_of, words).tolist():
                found[text_of[at]].append({"label": label, "start": at - int(bounds[text_of[at]])})
        for at in np.flatnonzero(np.isin(hashes, firsts)).tolist():
            row = int(text_of[at])
            low, high = int(bounds[row]), int(bounds[row + 1])
            for label, automaton in by_first[int(hashes[at])]:
                end = automaton.longest(hashes, at, high)
                if end >= 0:
                    accepted[row].append({"label": label, "start": at - low, "end": end - low})
        place = lambda hit: (hit["start"], hit["label"])
        phrase_hits.extend(sorted(x, key=place) for x in found)
        template_hits.extend(sorted(x, key=place) for x in accepted)

    kinds = (pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())])),
             pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))

    def work(column: pa.Array) -> list:
        counts, phrase_hits, template_hits = [], [], []
        for chunk in chunks(column):
            scan(chunk, counts, phrase_hits, template_hits)
        return [pa.array(counts, pa.int64()), pa.array(phrase_hits, kinds[0]), pa.array(template_hits, kinds[1])]

    return over_texts(docs, key, text, "n_words bigint, phrase_hits array<struct<label:string,start:bigint>>, "
                      "template_hits array<struct<label:string,start:bigint,end:bigint>>", work)


def license_report(scan: DataFrame, key: str = "doc_id") -> DataFrame:
    """Labels and positions per text: base labels come from phrases, ``labels`` also from accepted
    templates; ``score`` is 1 with an accepted template, 0.5 with a phrase alone, else 0."""
    places = F.col("phrase_hits.start")
    labels = F.array_distinct(F.col("phrase_hits.label"))
    full = F.size("template_hits") > 0
    return scan.select(
        key, "n_words", F.size("phrase_hits").cast("bigint").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        F.concat_ws(",", F.array_sort(labels)).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(labels, F.col("template_hits.label")))).alias("labels"),
        F.when(full, 1.0).when(F.size("phrase_hits") > 0, 0.5).otherwise(0.0).alias("score"),
        "template_hits")


# The phrases that name a license and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
           "mit license": "mit"}

# Common notices and the wording of short licenses.
_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
          "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
TEMPLATES = {
    "gpl-notice": "<<optional>>This <<words:1-3>> is <<end>>licensed under the <<optional>>terms of the <<end>>"
                  "GNU General Public License<<optional>>, version <<words:1-1>><<end>>",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0<<optional>> (the License)<<end>>",
    "cc-by-notice": "Licensed under CC BY 4.0<<optional>> International<<end>>",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0<<optional>> International<<end>>",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0<<optional>> International<<end>>",
    "mit-notice": "Released under the <<words:0-2>> MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the Software), to deal in the Software without restriction, "
                "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                "furnished to do so, subject to the following conditions: The above copyright notice and this "
                "permission notice <<optional>>(including the next paragraph) <<end>>shall be included in all copies "
                "or substantial portions of the Software. " + _AS_IS,
    "isc-text": "Permission to use, copy, modify, and<<optional>>/or<<end>> distribute this software for any purpose "
                "with or without fee is hereby granted, provided that the above copyright notice and this permission "
                "notice appear in all copies.",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                "provided that the following conditions are met: <<optional>>1.<<end>> Redistributions of source code "
                "must retain the above copyright notice, this list of conditions and the following disclaimer. "
                "<<optional>>2.<<end>> Redistributions in binary form must reproduce the above copyright notice, this "
                "list of conditions and the following disclaimer in the documentation and/or other materials provided "
                "with the distribution. <<optional>>3. Neither the name of <<words:1-12>> nor the names of its "
                "contributors may be used to endorse or promote products derived from this software without specific "
                "prior written permission.<<end>>",
}
