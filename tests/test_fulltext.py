"""BM25 against a plain Python computation."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from helpers import frame, ids, ranked
from pyspark.sql import functions as F

from hybridframe.functions.text import split_terms, term_counts, term_frequency, tokens
from hybridframe.operators import fulltext

WORDS = "alpha beta gamma delta epsilon zeta eta theta".split()


def make_rows():
    """A third of the texts are the same, and one term is in nearly all."""
    rows = []
    for i in range(90):
        text = "the same text, the very same" if i % 3 == 0 else " ".join(["The"] + [WORDS[(i * j) % 8] for j in range(1, 4 + i % 9)])
        rows.append((f"d{i:02d}", text, None, {"even": i % 2 == 0}))
    rows += [("empty", "", None, None), ("marks", "?! -", None, None), ("null", None, None, None)]
    return rows


def brute(rows, terms, k, allowed=lambda row: True):
    texts = {r[0]: split_terms(r[1]) for r in rows if r[1] is not None}
    n, average = len(texts), sum(map(len, texts.values())) / len(texts)
    df = {t: sum(t in words for words in texts.values()) for t in terms}
    scored = []
    for row in rows:
        words = Counter(texts.get(row[0], ()))
        if not allowed(row) or not any(words[t] for t in terms):
            continue
        length = sum(words.values())
        score = sum(
            math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * words[t] * 2.2 / (words[t] + 1.2 * (0.25 + 0.75 * length / average)) for t in terms
        )
        scored.append((-round(score, 6), row[0]))
    return [(ident, pytest.approx(-score, abs=2e-6)) for score, ident in sorted(scored)[:k]]


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def texts(spark, rows):
    return frame(spark, rows).repartition(4).cache()


def listed(hits):
    return [(r["_id"], r["score"]) for r in sorted(hits.collect(), key=lambda r: r["rank"])]


def test_terms(spark):
    df = spark.createDataFrame([("Ab, cd! ab é5é",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(tokens(F.col("t"))).collect()] == [["ab", "cd", "ab", "é5é"], [], None]
    counts = df.select(term_counts(tokens(F.col("t"))).alias("c")).collect()
    assert [(c["term"], c["tf"]) for c in counts[0]["c"]] == [("ab", 2), ("cd", 1), ("é5é", 1)]
    assert not counts[1]["c"] and counts[2]["c"] is None
    assert [r[0] for r in df.select(term_frequency(tokens(F.col("t")), "ab")).collect()][:2] == [2, 0]


def test_search_any(texts, rows):
    for text in ("the", "alpha theta", "same alpha nowhere", "nowhere"):
        expected = brute(rows, split_terms(text), 10)
        assert listed(fulltext.search_text(texts, {"$contains": text}, 10)) == expected
    assert ranked(fulltext.search_text(texts, "the same", 3)) == ["d00", "d03", "d06"]


def test_search_all_and_filtered(texts, rows):
    where = {"$and": [{"$contains": "alpha"}, {"$contains": "theta"}]}
    both = brute(rows, ["alpha", "theta"], 10, lambda r: {"alpha", "theta"} <= set(split_terms(r[1] or "")))
    assert listed(fulltext.search_text(texts, where, 10)) == both
    even = brute(rows, ["the"], 10, lambda r: r[3] and r[3]["even"])
    assert listed(fulltext.search_text(texts, "the", 10, {"even": True})) == even


def test_regex_alone_scores_one(texts):
    hits = fulltext.search_text(texts, {"$regex": "^the same"}, 4)
    assert listed(hits) == [("d00", 1.0), ("d03", 1.0), ("d06", 1.0), ("d09", 1.0)]


@pytest.mark.parametrize("triples", [fulltext.MAX_TRIPLES, 5])
def test_batch_index_and_single_search_agree(spark, texts, rows, tmp_path, monkeypatch, triples):
    if triples == 5:
        monkeypatch.setattr(fulltext, "QUERY_BLOCK", 2)
    monkeypatch.setattr(fulltext, "MAX_TRIPLES", triples)
    asked = ["the", "alpha beta", "same theta the", "nowhere", "zeta zeta"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, text string")
    fulltext.write_index(texts, str(tmp_path / "index"), parts=5)
    index = fulltext.read_index(spark, str(tmp_path / "index"))
    batch = fulltext.search_text_batch(texts, queries, 10, include=())
    posted = fulltext.search_index_batch(index, queries, 10)
    unstored = fulltext.search_index_batch(fulltext.build_index(texts), queries, 10)
    for q, text in enumerate(asked):
        expected = brute(rows, list(dict.fromkeys(split_terms(text))), 10)
        for hits in (batch, posted, unstored):
            assert listed(hits.filter(F.col("query_id") == q)) == expected
        assert listed(fulltext.search_index(index, text, 10)) == expected


def test_small_arrow_batches_keep_documents_whole(spark, texts, rows):
    queries = spark.createDataFrame([(0, "the alpha beta gamma delta same text")], "query_id int, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        hits = listed(fulltext.search_text_batch(texts, queries, 20, include=()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert hits == brute(rows, "the alpha beta gamma delta same text".split(), 20)


def test_index_with_filter_and_and(spark, texts, rows, tmp_path):
    fulltext.write_index(texts, str(tmp_path / "index"))
    index = fulltext.read_index(spark, str(tmp_path / "index"))
    where = {"$and": [{"$contains": "alpha"}, {"$contains": "theta"}]}
    assert listed(fulltext.search_index(index, where, 10)) == listed(fulltext.search_text(texts, where, 10))
    passing = texts.filter("_id < 'd40'")
    allowed = brute(rows, ["the"], 10, lambda r: r[0] < "d40")
    assert listed(fulltext.search_index(index, "the", 10, passing)) == allowed
    plan = fulltext.postings_of(index, ["the"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [(part" in plan or "PartitionFilters: [part" in plan


def test_filtered_batch(spark, texts, rows):
    queries = spark.createDataFrame([("q", "the alpha")], "query_id string, text string")
    hits = fulltext.search_text_batch(texts, queries, 10, {"even": True})
    assert listed(hits) == brute(rows, ["the", "alpha"], 10, lambda r: r[3] and r[3]["even"])
    assert ids(hits) <= ids(texts) and "document" in hits.columns


def test_terms_are_counted_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fulltext, "COUNTED_TERMS", 2)
    texts = ["Ä b, ä-B b", None, "", " ,; ", "x1 ǅ x1", "same", "same"]
    df = spark.createDataFrame([(str(i), text, i % 2 == 0) for i, text in enumerate(texts)], "_id string, document string, passes boolean")
    posted = fulltext.postings(df, keep=("passes",))
    assert "MapInArrow" in posted._jdf.queryExecution().toString()
    assert [f.simpleString() for f in posted.schema] == ["term:string", "_id:string", "passes:boolean", "tf:int", "length:int"]
    got = sorted(tuple(r) for r in posted.collect())
    assert got == sorted([("ä", "0", True, 2, 5), ("b", "0", True, 3, 5), ("x1", "4", True, 2, 3), ("ǆ", "4", True, 1, 3), ("same", "5", False, 1, 1), ("same", "6", True, 1, 1)])
    fulltext.write_index(df, str(tmp_path / "index"))
    row = fulltext.read_index(spark, str(tmp_path / "index")).corpus.first()
    assert (row["n"], row["average"]) == tuple(fulltext.corpus(df).first()) == (6, 10 / 6)
