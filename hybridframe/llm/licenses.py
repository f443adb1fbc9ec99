"""License scans by patience alignment of texts with notices."""

from __future__ import annotations

import functools
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridframe.llm.common import documents, query

# Usual notices of well-known licenses.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "BSD-conditions": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
}
COVERAGE = 0.9
WORDS = re.compile(r"\w+")


@functools.lru_cache(1)
def templates() -> dict[str, str]:
    """The notices, and the whole licences (named with ``-text``) and usual headers in the folder ``license_texts``."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return NOTICES | {x.stem + ("" if x.stem.endswith("-header") else "-text"): x.read_text("utf-8") for x in files}


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def align(text: list[str], notice: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of equal words, rising in both.

    Words that are there once in both are anchors; the longest run of them that rises in both is kept
    (patience sorting), and the gaps between them are aligned in the same way. In a gap without anchors equal words
    at both ends are matched, and what lies between is aligned once more if that has made words unique.
    """
    pairs, gaps = [], [(0, len(text), 0, len(notice))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and text[a0] == notice[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and text[a1 - 1] == notice[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_text, in_notice = Counter(text[a0:a1]), Counter(notice[b0:b1])
        place = {w: i for i, w in enumerate(text[a0:a1], a0) if in_text[w] == 1}
        anchors = rising([(place[w], j) for j, w in enumerate(notice[b0:b1], b0) if in_notice[w] == 1 and w in place])
        if anchors:
            pairs += anchors
            ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            gaps += [(x[0] + 1, y[0], x[1] + 1, y[1]) for x, y in zip(ends, ends[1:])]
    return sorted(pairs)


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence, in the given order, in which the first number rises."""
    tops, at, back = [], [], []
    for k, (a, _) in enumerate(pairs):
        pile = bisect_left(tops, a)
        back.append(at[pile - 1] if pile else -1)
        tops[pile : pile + 1], at[pile : pile + 1] = [a], [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def least(notice: list[str]) -> int:
    """How many of its words must be aligned."""
    return math.ceil(COVERAGE * len(notice) - 1e-9)


def find(words: list[str], notice: list[str]) -> list[tuple[int, int, int]]:
    """All places with enough words of the notice: the number of words, and their first and last position in the text.

    A place lacks at most ``spare`` positions of the notice, so of any words that fill more of its positions one is
    there. The rarest in the text are taken, and the text is aligned around each place of theirs: as far as the place
    of the word in the notice tells, a notice's length further to both sides (as many words may be put in), and a notice's length around the word. Of places that overlap the fullest stays.
    """
    counts, wanted, size, need = Counter(words), Counter(notice), len(notice), least(notice)
    rare, filled = {}, 0
    for word in sorted(wanted, key=lambda w: (counts[w], w)):
        if filled > size - need:
            break
        filled += wanted[word]
        rare[word] = [j for j, w in enumerate(notice) if w == word]
    places, whole = [], -1
    for at, word in enumerate(words):
        if at <= whole or word not in rare:
            continue
        spare = size - need
        for start, stop in {*((at - j - w, at - j + size + w) for j in rare[word] for w in (spare, size)), (at - size, at + size)}:
            start = max(0, start)
            pairs = align(words[start:stop], notice)
            if len(pairs) >= need:
                places.append((len(pairs), start + pairs[0][0], start + pairs[-1][0]))
                if len(pairs) == size == places[-1][2] - places[-1][1] + 1:
                    whole = max(whole, places[-1][2])
    out = []
    for x in sorted(set(places), key=lambda x: (-x[0], x[2] - x[1], x[1])):
        if all(x[2] < y[1] or x[1] > y[2] for y in out):
            out.append(x)
    return sorted(out, key=lambda x: x[1])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: dict[str, str] | None = None, carry=()) -> DataFrame:
    """``row`` (id and ``carry``) and ``found``, an array of ``license coverage first_word last_word spans``, for every row of ``df``.

    A notice is found where at least 0.9 of its words (case and punctuation aside) are aligned; ``coverage`` is
    their share, and first and last are words of the whole text. These are of the fullest place, ``spans`` has
    all places (``coverage first_word last_word``) in order. A place within a longer notice's is part of it. Only
    texts that contain enough of a notice's words at all are aligned. Null and empty texts have none; repeated rows have the same.
    """
    wanted = {name: words_of(text) for name, text in (notices or templates()).items()}

    def run(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # the longest words first, as these are missing soonest
        known = {name: sorted(Counter(words).items(), key=lambda x: (-len(x[0]), x[0])) for name, words in wanted.items()}
        for texts in columns:
            out = []
            for text in texts:
                words, places = words_of(text or ""), []
                own = set(words)
                for name, notice in wanted.items():
                    spare = len(notice) - least(notice)
                    if len(words) < len(notice) - spare:
                        continue
                    for word, times in known[name]:
                        if word not in own:
                            spare -= times
                            if spare < 0:
                                break
                    if spare >= 0:
                        places += [(name, *x) for x in find(words, notice)]
                places = [x for x in places if not any(y[1] > x[1] and y[2] <= x[2] and x[3] <= y[3] for y in places)]
                found = []
                for name in wanted:
                    spans = [{"coverage": n / len(wanted[name]), "first_word": a, "last_word": b} for of, n, a, b in places if of == name]
                    if spans:
                        found.append({"license": name, **max(spans, key=lambda x: x["coverage"]), "spans": spans})
                out.append(found)
            yield pd.Series(out, dtype=object)

    span = "coverage:double,first_word:int,last_word:int"
    found = F.pandas_udf(run, f"array<struct<license:string,{span},spans:array<struct<{span}>>>>")
    return df.select(F.struct(F.col(id_col).alias("id"), *carry).alias("row"), found(F.col(text_col)).alias("found"))


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir, "doc_id", "text")).select("row", F.array_sort("found").alias("found"))
    best = F.array_max(F.transform("found", lambda x: x["coverage"]))
    return found.select(
        F.col("row.id").alias("doc_id"), F.array_join(F.transform("found", lambda x: x["license"]), ",").alias("licenses"),
        F.size("found").alias("n_licenses"), F.coalesce(best, F.lit(0.0)).alias("coverage"),
        F.aggregate("found", F.lit(0), lambda n, x: n + F.size(x["spans"])).alias("n_spans"),
    )
