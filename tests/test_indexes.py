"""Block maxima, indexes after changes, and text filters through indexes, each against the plain form."""

from __future__ import annotations

import random
import time

import pytest
from helpers import EIGHT, frame, ids, ranked
from pyspark.sql import functions as F

from hybridframe.operators import blocks, deltas, fulltext, lookup, retrieve

WORDS = ["path", "forest", "ridge", "old", "mill", "lake", "moor", "snow", "road", "a", "river"]


@pytest.fixture(scope="module")
def many(spark):
    """Texts of very different lengths, null and empty ones, and one term that nearly all have."""
    rng = random.Random(21)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    texts = [" ".join(rng.choices(WORDS, weights, k=rng.choice([1, 3, 10, 60]))) for _ in range(400)] + [None, "", "!!", "Snow", "snow snow"]
    return frame(spark, [(f"m{i:03d}", text, None, {"i": i}) for i, text in enumerate(texts)]).cache()


FILTERS = [
    {"$contains": "snow river"}, "path", {"$contains": "unknown"},
    {"$and": [{"$contains": "moor lake"}, {"$contains": "old"}]}, {"$or": [{"$contains": "snow"}, {"$contains": "mill"}]},
]


@pytest.fixture(scope="module")
def stored(spark, many, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("blocks") / "index")
    blocks.write_blocks(many, path, parts=4, bits=3)
    return blocks.read_blocks(spark, path)


@pytest.mark.parametrize("where", FILTERS)
def test_blocks_give_the_rows_of_the_scan(many, stored, where):
    want = [(r["_id"], round(r["score"], 9)) for r in sorted(fulltext.search_text(many, where, 7, include=()).collect(), key=lambda r: r["rank"])]
    got = [(r["_id"], round(r["score"], 9)) for r in sorted(blocks.search_blocks(stored, where, 7).collect(), key=lambda r: r["rank"])]
    assert got == want


def test_blocks_are_left_out_and_bounds_hold(many, stored, monkeypatch):
    monkeypatch.setattr(blocks, "FIRST", 3)
    row = blocks.blocks_read(stored, {"$contains": "snow river"}, 3).first()
    assert 0 < row["reached"] < row["blocks"]
    limits = {r["block"]: r["bound"] for r in blocks.bounds(stored, {"$contains": "snow river"}).collect()}
    every = blocks._scored(stored, {"$contains": "snow river"}, blocks.bounds(stored, {"$contains": "snow river"}), None).collect()
    assert every and all(r["score"] <= limits[r["block"]] * (1 + 1e-9) for r in every)


def test_postings_are_put_in_blocks_without_a_shuffle(spark, many):
    """A block that lies in several batches is one; nothing is shuffled for it."""
    posted = [(f"t{i % 5}", i // 40, i / 7, f"d{i}" if i % 9 else None, i % 3 + 1, 8) for i in range(200)]
    rows = spark.createDataFrame(posted, "term string, block long, most double, _id string, tf int, length int").coalesce(1)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "7")
    try:
        made = blocks._in_blocks(rows)
        assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
        got = {(r["term"], r["block"]): (r["most"], sorted(map(str, r["held"]))) for r in made.collect()}
        assert made.count() == len(got)
    finally:
        spark.conf.set(size, before)
    held = F.collect_list(F.struct("_id", "tf", "length")).alias("held")
    want = rows.groupBy("term", "block").agg(F.max("most").alias("most"), held).collect()
    assert got == {(r["term"], r["block"]): (r["most"], sorted(map(str, r["held"]))) for r in want}


def test_blocks_with_a_metadata_filter_and_refusals(many, stored):
    passing = retrieve.select_records(many, None, {"i": {"$lt": 50}}).select("_id")
    got = ranked(blocks.search_blocks(stored, {"$contains": "snow river"}, 5, passing))
    assert got == ranked(fulltext.search_text(many, {"$contains": "snow river"}, 5, {"i": {"$lt": 50}}, ()))
    for search in (blocks.search_blocks, lambda index, where: fulltext.search_index(index, where)):
        with pytest.raises(ValueError):
            search(stored, {"$regex": "a"})


def test_index_after_changes_equals_a_new_one(spark, many, tmp_path):
    fulltext.write_index(many, str(tmp_path / "index"), 4)
    index = fulltext.read_index(spark, str(tmp_path / "index"))
    number = F.substring("_id", 2, 3).cast("int")
    kept = many.filter(number % 7 != 0).withColumn("document", F.when(number % 7 == 1, F.concat("document", F.lit(" Snow moor"))).otherwise(F.col("document")))
    after = kept.unionByName(frame(spark, [("new1", "snow on the ridge", None, {}), ("new2", None, None, {}), ("new3", "", None, {})]))
    minus, plus = deltas.changed_records(many, after, ("document",))
    assert ids(minus) == {r["_id"] for r in many.collect() if int(r["_id"][1:]) % 7 == 0 or (int(r["_id"][1:]) % 7 == 1 and r["document"] is not None)}
    changed, fresh = deltas.text_index_after(index, minus, plus), fulltext.build_index(after)
    assert {(r["term"], r["df"]) for r in changed.frequencies.collect()} == {(r["term"], r["df"]) for r in fresh.frequencies.collect()}
    assert tuple(changed.corpus.first())[:2] == pytest.approx(tuple(fresh.corpus.first())[:2])
    for where in FILTERS:
        assert ranked(fulltext.search_index(changed, where, 9)) == ranked(fulltext.search_index(fresh, where, 9))
    questions = spark.createDataFrame([(1, "snow river"), (2, "the ridge"), (3, None), (4, "nothing here")], "query_id int, text string")
    rows = lambda hits: sorted((r["query_id"], r["rank"], r["_id"], round(r["score"], 9)) for r in hits.collect())
    assert rows(fulltext.search_index_batch(changed, questions, 6)) == rows(fulltext.search_text_batch(after, questions, 6, include=()))
    none = deltas.text_index_after(index, many, many.limit(0))
    assert none.frequencies.count() == 0 and fulltext.search_index(none, "path", 3).count() == 0


def test_tiles_of_a_text_batch(spark, many, monkeypatch):
    questions = spark.createDataFrame([(i, " ".join(WORDS[i % 11 : i % 11 + 3])) for i in range(30)], "query_id int, text string")
    rows = lambda hits: sorted((r["query_id"], r["rank"], r["_id"], round(r["score"], 9)) for r in hits.collect())
    whole = rows(fulltext.search_text_batch(many, questions, 4, include=()))
    assert len(whole) == 120
    for i in (0, 5, 17):
        one = fulltext.search_text(many, {"$contains": " ".join(WORDS[i % 11 : i % 11 + 3])}, 4, include=()).collect()
        assert [r[1:] for r in whole if r[0] == i] == sorted((r["rank"], r["_id"], round(r["score"], 9)) for r in one)
    monkeypatch.setattr(fulltext, "QUERY_BLOCK", 4)
    monkeypatch.setattr(fulltext, "TILE_POSTINGS", 100)
    assert rows(fulltext.search_text_batch(many, questions, 4, include=())) == whole
    assert fulltext.search_text_batch(many, questions.limit(0), 4).count() == 0


@pytest.mark.parametrize(
    ("pattern", "literals"),
    [
        ("forest", ["forest"]), ("fore?st", ["for"]), ("^old mill$", ["old mill"]), ("(old|new) mill", []), ("a.*ridge+s", ["ridge"]),
        ("[Pp]ath to", ["ath to"]), ("(?i)path", []), (r"\bpath\b x", ["path"]), (r"two\. three", ["two. three"]), ("paths*", ["path"]),
        ("(abc)?defg", ["defg"]), ("(abc)defg", ["defg"]), ("abc{2}xyz", ["xyz"]), (r"\x41bcd", []), ("[[a]b]cde", []), ("ab", []), ("", []),
    ],
)
def test_literals_that_a_pattern_needs(pattern, literals):
    assert lookup.required_literals(pattern) == literals


LOOKUPS = [
    ({"$contains": "FOREST snowshoes"}, "terms"), ("path", "terms"), ({"$contains": ""}, "terms"), ({"$contains": "est pa"}, "substring"),
    ({"$contains": "pa"}, "substring"), ({"$regex": "[Ff]orest path"}, "terms"), ({"$regex": "a.*(ridge|mill)"}, "terms"), ({"$regex": "x*"}, "terms"),
    ({"$and": [{"$contains": "path"}, {"$regex": "ridge"}]}, "terms"), ({"$or": [{"$contains": "moor"}, {"$regex": "old mill"}]}, "terms"),
    ({"$or": [{"$contains": "moor"}, {"$regex": "(?i)FOREST"}]}, "terms"), ({"$contains": "ridge", "$regex": "day"}, "terms"), ({"$contains": "path "}, "substring"),
]


@pytest.mark.parametrize(("where", "mode"), LOOKUPS)
def test_lookups_equal_the_scan(spark, tmp_path_factory, where, mode):
    rows = frame(spark, EIGHT + [("n", None, None, {}), ("e", "", None, {}), ("s", "pa", None, {})])
    path = str(tmp_path_factory.mktemp("grams") / "g")
    lookup.write_grams(rows, path, 4)
    terms, grams = fulltext.build_index(rows), lookup.read_grams(spark, path, 4)
    assert ids(lookup.select_documents(rows, where, terms, grams, mode)) == ids(retrieve.select_records(rows, where_document=where, mode=mode))


def test_lookups_read_few_texts(spark, many, tmp_path):
    lookup.write_grams(many, str(tmp_path / "g"), 4)
    grams = lookup.read_grams(spark, str(tmp_path / "g"), 4)
    row = lookup.texts_read(many, {"$contains": "moor snow"}, None, grams, "substring").first()
    assert 0 < row["read"] < row["texts"] / 2
    with pytest.raises(ValueError):
        lookup.select_documents(many, {"$like": "a"}, None, grams)


def test_trigrams_take_a_text_apart_once(spark, tmp_path):
    """Long texts cost their length, not its square; characters outside of the basic plane are one each."""
    long = " ".join(f"w{i}é😀" for i in range(60_000))
    rows = frame(spark, [("a", "a😀bcé😀bc", None, {}), ("b", "xy", None, {}), ("c", None, None, {}), ("d", "aaaaa", None, {}), ("d", "aaaab", None, {})])
    got = {(r["_id"], r["document"]): r["g"] for r in rows.withColumn("g", lookup.distinct_grams(F.col("document"))).collect()}
    assert got["a", "a😀bcé😀bc"] == ["a😀b", "😀bc", "bcé", "cé😀", "é😀b"]
    assert got["b", "xy"] == [] and not got["c", None] and got["d", "aaaab"] == ["aaa", "aab"]
    started = time.monotonic()
    assert frame(spark, [("l", long, None, {})]).select(F.size(lookup.distinct_grams(F.col("document"))).alias("n")).first()["n"] == len(
        {long[i : i + 3] for i in range(len(long) - 2)}
    )
    assert time.monotonic() - started < 30
    lookup.write_grams(rows, str(tmp_path / "g"), 4)
    found = lookup.select_documents(rows, {"$contains": "aaab"}, None, lookup.read_grams(spark, str(tmp_path / "g"), 4), "substring")
    assert [(r["_id"], r["document"]) for r in found.collect()] == [("d", "aaaab")]


def test_deep_pages(spark, many, tmp_path):
    retrieve.write_pages(many, str(tmp_path / "pages"), 5)
    order = sorted(r["_id"] for r in many.collect())
    for offset, limit in ((0, 10), (203, 50), (len(order) - 4, 10), (len(order), 5), (10_000, 5)):
        got = retrieve.deep_page(many, str(tmp_path / "pages"), limit, offset)
        assert [r["_id"] for r in got.collect()] == order[offset : offset + limit]
    plan = retrieve.deep_page(many, str(tmp_path / "pages"), 10, 200)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(range" in plan or "PartitionFilters: [range" in plan
