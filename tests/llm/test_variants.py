"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from hybridframe.llm import variants

SMALL = {c: c + 32 for c in range(65, 91)}


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_force(counts: dict, ratio: int = 10) -> set:
    found = {}
    for word, n in counts.items():
        others = [(-m, other) for other, m in counts.items() if near(word, other)]
        best = min(others, default=None)
        form = best[1] if best and -best[0] >= ratio * n else None
        found[word] = (form, n, len(others), -best[0] if form else None)
    rows = set()
    for word, (form, n, count, form_n) in found.items():
        root = word
        while found[root][0]:
            root = found[root][0]
        rows.add((word, form, root, n, count, form_n))
    return rows


def rows_of(frame) -> list:
    return [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def test_groups(spark):
    rng = random.Random(4)
    counts = {}
    for _ in range(120):
        word = "".join(rng.choices("aab", k=rng.randint(0, 7)))
        counts[word] = rng.choice([1, 1, 2, 9, 10, 11, 100, 1000, 20000])
    counts |= {"": 3, "é": 2, "ê": 400, "𝄞a": 1, "𝄞b": 50, "a$b": 10, "a$c": 100, "$": 4, "$$": 50, "ab$": 1}
    frame = spark.createDataFrame([(w, n, "x") for w, n in counts.items()] + [(None, 5, "y"), ("aab", 7, "z")], "word string, n long, name string")
    counts["aab"] = counts.get("aab", 0) + 7
    got = rows_of(variants.spelling_groups(frame))
    assert len(got) == len(counts) and set(got) == brute_force(counts)


@pytest.mark.parametrize("long", [64, 5])
def test_long_words(spark, monkeypatch, long):
    """Words around the length from which rotations are hashed, with repeated letters, ties and edits at every place."""
    monkeypatch.setattr(variants, "LONG", long)
    rng, counts = random.Random(5), {}
    for size in {3, long - 2, long - 1, long, long + 1, long + 2, 3 * long}:
        base = "".join(rng.choices("ab", k=size))
        for word in {base, base[1:], base[:-1], base + "b", "a" + base, base[:2] + "c" + base[3:], base[:-2] + "cc", "a" * size, "a" * size + "b", "b" + "a" * size, "a" * size + "d"}:
            counts[word] = rng.choice([1, 5, 50, 50, 600])
    got = rows_of(variants.spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert len(got) == len(counts) and set(got) == brute_force(counts)


def test_a_word_of_very_many_letters(spark):
    word = "acgt" * 20_000
    counts = {word: 1000, word[:9] + word[10:]: 3, "a" * 50_000: 2}
    got = {r[0]: r for r in rows_of(variants.spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long")))}
    assert got[word[:9] + word[10:]][1] == word and got[word][4] == 1 and got["a" * 50_000][4] == 0


def test_empty_table(spark):
    assert variants.spelling_groups(spark.createDataFrame([], "word string, n long")).count() == 0
    frame = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert variants.spelling_groups(variants.counted_words(frame)).count() == 0


def slipped(rows, least=7, slip=31) -> Counter:
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % slip == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= least:
                counts[word] += 1
    return counts


def test_counted_words(docs):
    rng = random.Random(6)
    words = ["Straßenbahn", "straßenbahn", "ÉCOLIERE", "écoliere", "abcdefg", "abcdef", "x" * 300, "multi×plied", "ñandúes", "Wort"]
    rows = [(i, " ".join(rng.choices(words, k=40)).replace(" ", rng.choice([" ", ". ", "1", "漢"]))) for i in range(50)] + [(None, words[0]), (3, None), (3, ""), (4, words[4])]
    got = {r.word: r.n for r in variants.counted_words(docs([t for _, t in rows], [i for i, _ in rows])).collect()}
    assert got == dict(slipped(rows))


def test_query_against_all_pairs(spark):
    """The registered query on documents whose words differ by edits, all pairs compared."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    counts = {w: n for w, n in slipped(rows).items() if n >= 2}
    found = variants.op13(spark, "/root/testdata/sf0.001")
    assert dict(found.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    got = {r[0]: r for r in rows_of(found)}
    assert {w: r[3] for w, r in got.items()} == counts
    by_cut = {}
    for word in counts:
        for key in {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}:
            by_cut.setdefault(key, set()).add(word)
    candidates = {word: set() for word in counts}
    for own in by_cut.values():
        for word in own:
            candidates[word] |= {other for other in own if near(word, other)}
    for word, others in candidates.items():
        best = min(((-counts[o], o) for o in others), default=None)
        form = best[1] if best and -best[0] >= 10 * counts[word] else None
        assert got[word][1] == form and got[word][4] == len(others) and got[word][5] == (counts[form] if form else None)
