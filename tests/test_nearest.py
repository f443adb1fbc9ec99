"""Exact search against brute force in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from helpers import frame, ranked
from pyspark.sql import functions as F

from hybridframe.functions import vectors
from hybridframe.operators import nearest as module
from hybridframe.operators import tiles
from hybridframe.operators.nearest import nearest, nearest_batch, query_frame

METRICS = ["l2", "cosine", "inner_product"]


def brute(rows, query, metric, k):
    scored = []
    for ident, vector in rows:
        if vector is None or len(vector) != len(query):
            continue
        x, q = np.asarray(vector, np.float32).astype(float), np.asarray(query, float)
        if metric == "l2":
            d = np.sqrt(((x - q) ** 2).sum())
        elif metric == "inner_product":
            d = (x * q).sum()
        else:
            length = np.sqrt((x**2).sum()) * np.sqrt((q**2).sum())
            if length == 0:
                continue
            d = max(1 - (x * q).sum() / length, 0.0)
        scored.append((round(-d if metric == "inner_product" else d, 9), ident))
    return [ident for _, ident in sorted(scored)[:k]]


@pytest.fixture(scope="module")
def vectors_with_copies():
    """A third of all records share one vector; some have none, a wrong size, or no length."""
    rng = np.random.default_rng(5)
    rows = [(f"v{i}", rng.normal(size=8).round(3).tolist()) for i in range(300)]
    rows += [(f"copy{i}", rows[0][1]) for i in range(150)]
    rows += [("none", None), ("short", [1.0, 2.0]), ("zero", [0.0] * 8)]
    rng.shuffle(rows := [tuple(r) for r in rows])
    return rows


@pytest.mark.parametrize("metric", METRICS)
def test_against_brute_force(spark, vectors_with_copies, metric):
    df = frame(spark, [(i, None, v, None) for i, v in vectors_with_copies]).repartition(5)
    known = dict(vectors_with_copies)
    queries = [known["v0"], known["v7"], np.random.default_rng(1).normal(size=8).tolist()]
    hits = nearest_batch(df, query_frame(spark, queries), 12, metric, include=()).collect()
    for q, query in enumerate(queries):
        expected = brute(vectors_with_copies, query, metric, 12)
        assert ranked(nearest(df, query, 12, metric, include=())) == expected
        assert [h["_id"] for h in sorted((h for h in hits if h["query_id"] == q), key=lambda h: h["rank"])] == expected


def test_query_blocks_give_the_same(spark, vectors_with_copies, monkeypatch):
    df = frame(spark, [(i, None, v, None) for i, v in vectors_with_copies])
    queries = query_frame(spark, [v for _, v in vectors_with_copies if v is not None and len(v) == 8][:40])
    whole = sorted(map(tuple, nearest_batch(df, queries, 3, "l2", include=()).collect()))
    monkeypatch.setattr(module, "QUERY_BLOCK", 7)
    monkeypatch.setattr(tiles, "QUERIES", 7)
    monkeypatch.setattr(tiles, "RECORDS", 50)
    split = nearest_batch(df, queries, 3, "l2", include=())
    assert sorted(map(tuple, split.collect())) == whole


def test_a_stored_vector_finds_itself(five):
    for metric in ("l2", "cosine"):
        for row in five.collect():
            hits = nearest(five, row["embedding"], 1, metric, include=()).collect()
            assert hits[0]["distance"] == pytest.approx(0, abs=1e-6)


def test_fixture_order_and_filters(five):
    assert ranked(nearest(five, [4, 0, 1], 3, "l2")) == ["r1", "r3", "r5"]
    assert ranked(nearest(five, [4, 0, 1], 10, "l2", {"price": {"$lte": 48}})) == ["r3", "r5", "r2"]
    assert ranked(nearest(five, [4, 0, 1], 10, "l2", None, {"$contains": "green"})) == ["r2", "r4"]
    assert ranked(nearest(five, [9, 9, 9], 1, "inner_product")) == ["r4"]
    assert nearest(five, [1.0, 2.0], 3, "l2").count() == 0


def test_long_vectors(spark):
    long = [float(i % 7) for i in range(vectors.UNROLL + 5)]
    df = frame(spark, [("a", None, long, None), ("b", None, long[::-1], None)])
    for metric in METRICS:
        hits = nearest(df, long, 2, metric)
        assert ranked(hits) == ["a", "b"]
        by_lambda = {r["_id"]: r["d"] for r in df.select("_id", vectors.distance(metric, "embedding", long).alias("d")).collect()}
        assert {r["_id"]: r["distance"] for r in hits.collect()} == pytest.approx(by_lambda)


def test_distance_between_columns(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0])], "a array<float>, b array<float>")
    row = df.select(*[vectors.distance(m, "a", "b").alias(m) for m in METRICS]).first()
    assert row["l2"] == pytest.approx(5**0.5, abs=1e-9) and row["cosine"] == 1.0 and row["inner_product"] == 0.0


def test_metric_names():
    assert vectors.metric_or_default("ip") == "inner_product"
    with pytest.warns(UserWarning):
        assert vectors.metric_or_default(None) == "l2"


def test_string_query_ids_and_no_queries(five):
    spark = five.sparkSession
    named = spark.createDataFrame([("a", [1.0, 2.0, 3.0]), ("b", None)], "query_id string, vector array<double>")
    hits = nearest_batch(five, named, 2, "l2")
    assert {row["query_id"] for row in hits.collect()} == {"a"} and set(hits.columns) == {"query_id", "rank", "_id", "distance", "document", "metadata"}
    assert nearest_batch(five, named.limit(0), 2, "l2").count() == 0


def test_similarity(spark):
    row = spark.createDataFrame([(1.0,)], "d double").select(vectors.similarity(F.col("d"))).first()
    assert row[0] == 0.5


@pytest.mark.parametrize("metric", METRICS)
def test_a_block_is_measured_together(monkeypatch, metric):
    """The pairs that may be among the first are measured together, not query by query; the lists are those of brute force."""
    calls, measure, rng = [], module._measure, np.random.default_rng(3)
    monkeypatch.setattr(module, "_measure", lambda *args: calls.append(1) or measure(*args))
    x, asked = rng.normal(size=(4000, 8)).astype(np.float32), rng.normal(size=(500, 8))
    x[::3] = x[0]
    lists = module.NearestLists(metric, module.QueryBlock(list(range(500)), asked), 5)
    lists.add(pa.record_batch([pa.array([f"v{i}" for i in range(4000)]), pa.array(list(x))], names=["_id", "embedding"]))
    found = pa.Table.from_batches(lists.batches(pa.int64(), ["query_id", "_id", "distance"])).to_pandas()
    assert len(calls) < 500
    rows = [(f"v{i}", v.tolist()) for i, v in enumerate(x)]
    for q in (0, 250, 499):
        assert found[found.query_id == q]._id.tolist() == brute(rows, asked[q].tolist(), metric, 5)


@pytest.mark.parametrize("metric", METRICS)
def test_lengths_beyond_single_precision(metric):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4)) * 10.0 ** rng.integers(-18, 18, (300, 1))
    asked = np.concatenate([rng.normal(size=(6, 4)), np.zeros((1, 4))])
    for scale in (1.0, 1e-20, 1e16):
        lists = module.NearestLists(metric, module.QueryBlock(list(range(7)), asked * scale), 4)
        lists.add(pa.record_batch([pa.array([f"v{i}" for i in range(300)]), pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))], names=["_id", "embedding"]))
        found = pa.Table.from_batches(lists.batches(pa.int64(), ["query_id", "_id", "distance"])).to_pandas()
        for q, query in enumerate(asked * scale):
            with np.errstate(all="ignore"):
                lengths = np.sqrt((x.astype(np.float32).astype(float) ** 2).sum(axis=1))
                exact = module._measure(metric, x.astype(np.float32).astype(float), lengths, query, np.sqrt((query**2).sum()))
            order = module.steady(-exact if metric == "inner_product" else exact)
            names = np.array([f"v{i}" for i in range(300)])
            at = [i for i in np.lexsort((names, order)) if order[i] == order[i]][:4]
            assert found[found.query_id == q]._id.tolist() == names[at].tolist()


def test_copies_beyond_k_are_left_out_of_a_tile():
    table = pa.table({"_id": [f"v{i:03}" for i in range(100)][::-1], "embedding": [[1.0, 2.0] if i % 2 else [float(i), 0.0] for i in range(100)]})
    kept = tiles.Compare("l2", 3, 2).distinct(table)
    copies = [row["_id"] for row in kept.to_pylist() if row["embedding"] == [1.0, 2.0]]
    assert sorted(copies) == ["v000", "v002", "v004"] and kept.num_rows == 53
