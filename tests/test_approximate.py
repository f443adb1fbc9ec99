from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from helpers import frame

from pyspark.sql import functions as F

from hybridframe.operators import approximate, hashing, nearest, quantised, tiles
from hybridframe.operators.nearest import nearest_batch, query_frame


@pytest.fixture(scope="module")
def clustered(spark):
    """Vectors around ten centres, one of which holds a third of them."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(10, 16)) * 4
    which = [0 if i % 3 == 0 else 1 + i % 9 for i in range(600)]
    rows = [(f"v{i:03d}", None, (centres[c] + rng.normal(size=16)).tolist(), {"c": c}) for i, c in enumerate(which)]
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def questions(spark):
    rng = np.random.default_rng(4)
    return query_frame(spark, (rng.normal(size=(20, 16)) * 4).tolist())


def rows(hits):
    return sorted((r["query_id"], r["rank"], r["_id"], r["distance"]) for r in hits.collect())


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_all_cells_are_exact_and_few_cells_recall_most(clustered, questions, metric):
    cells = approximate.train_cells(clustered, 8, 16, metric)
    indexed = approximate.build_cells(clustered, cells, 16, metric)
    exact = nearest_batch(clustered, questions, 5, metric, include=())
    assert rows(approximate.nearest_in_cells(indexed, cells, questions, 8, 5, metric)) == rows(exact)
    few = approximate.nearest_in_cells(indexed, cells, questions, 4, 5, metric)
    report = approximate.recall(few, exact).collect()
    assert len(report) == 20 and sum(r["found"] for r in report) / sum(r["k"] for r in report) > 0.8


def test_stored_cells_prune_and_filter(spark, clustered, questions, tmp_path):
    cells = approximate.train_cells(clustered, 8, 16, "l2")
    path = str(tmp_path / "cells")
    approximate.write_cells(approximate.build_cells(clustered, cells, 16, "l2"), path)
    stored = spark.read.parquet(path)
    one = questions.filter("query_id = 0")
    hits = approximate.nearest_in_cells(stored, cells, one, 2, 5, "l2", {"c": {"$lt": 5}}, ("metadata",))
    assert all('"c": ' in r["metadata"] for r in hits.collect())
    plan = hits._jdf.queryExecution().toString()
    assert "dynamicpruningexpression(cell" in plan


@pytest.fixture(scope="module")
def far_apart(spark, clustered):
    """Questions near the centres that records lie around."""
    rows = clustered.limit(600).collect()
    return query_frame(spark, [[float(x) for x in rows[i]["embedding"]] for i in range(0, 600, 30)])


@pytest.mark.parametrize("metric", ["l2", "cosine", "inner_product"])
def test_grid_equals_one_block(clustered, questions, monkeypatch, metric):
    whole = rows(nearest_batch(clustered, questions, 7, metric, include=()))
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 3)
    monkeypatch.setattr(tiles, "RECORDS", 100)
    monkeypatch.setattr(tiles, "QUERIES", 6)
    assert rows(nearest_batch(clustered, questions, 7, metric, include=())) == whole


def test_grid_plan_does_not_grow_with_the_queries(spark, clustered, monkeypatch):
    """No query in the plan and none in the driver: the plans for 4 and for 400 queries have the same number of steps."""
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 3)
    monkeypatch.setattr(tiles, "QUERIES", 2)
    sizes = []
    for n in (4, 400):
        asked = spark.range(n).select(F.col("id").alias("query_id"), F.array_repeat(F.col("id").cast("double"), 16).alias("vector"))
        hits = nearest_batch(clustered, asked, 3, "l2", include=())
        plan = hits._jdf.queryExecution().optimizedPlan().toString()
        assert "LocalRelation" not in plan.replace("LocalRelation <empty>", "") or n
        sizes.append(len(plan.splitlines()))
    assert sizes[0] == sizes[1]


def test_grid_with_nulls_wrong_sizes_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 1)
    records = frame(spark, [("a", None, [1.0, 0.0], {}), ("b", None, None, {}), ("c", None, [1.0, 2.0, 3.0], {}), ("d", None, [0.0, 0.0], {}), ("e", None, [0.0, 2.0], {})])
    asked = spark.createDataFrame([(0, [1.0, 1.0]), (1, None), (2, [0.0, 1.0])], "query_id int, vector array<double>")
    got = sorted((r.query_id, r.rank, r._id) for r in nearest_batch(records, asked, 5, "cosine", include=()).collect())
    assert got == [(0, 1, "a"), (0, 2, "e"), (2, 1, "e"), (2, 2, "a")]
    assert nearest_batch(records.limit(0), asked, 5, "l2", include=()).count() == 0
    with pytest.raises(ValueError):
        nearest_batch(records, spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "query_id int, vector array<double>"), 5)


def test_cells_compare_only_what_shares_a_cell(clustered, questions, monkeypatch):
    monkeypatch.setattr(tiles, "RECORDS", 50)
    monkeypatch.setattr(tiles, "QUERIES", 4)
    cells = approximate.train_cells(clustered, 8, 16, "l2")
    indexed = approximate.build_cells(clustered, cells, 16, "l2").cache()
    found = approximate.search_cells(indexed, cells, questions, 2, 5, "l2", 16)
    in_cell = {r["cell"]: r["count"] for r in indexed.groupBy("cell").count().collect()}
    routed = approximate.closest_cells(questions, "vector", cells, 2, "l2").collect()
    assert found.compared.agg(F.sum("compared")).first()[0] == sum(in_cell.get(cell, 0) for row in routed for cell in row["keys"])
    inside = {r["_id"]: r["cell"] for r in indexed.select("_id", "cell").collect()}
    probed = {row["query_id"]: set(row["keys"]) for row in routed}
    assert all(inside[r["_id"]] in probed[r["query_id"]] for r in found.ranked(5, "l2").collect())


def test_any_number_of_centroids(clustered, monkeypatch):
    cells = approximate.train_cells(clustered, 6, 16, "cosine")
    few = {r["_id"]: list(r["keys"]) for r in approximate.closest_cells(clustered, "embedding", cells, 3).collect()}
    monkeypatch.setattr(approximate, "BROADCAST_CENTROIDS", 3)
    many = {r["_id"]: list(r["keys"]) for r in approximate.closest_cells(clustered, "embedding", cells, 3).collect()}
    assert many == few


def test_text_filter_in_cells(spark, eight):
    cells = approximate.train_cells(eight, 2, 3, "l2")
    indexed = approximate.build_cells(eight, cells, 3, "l2")
    asked = query_frame(spark, [[0.0, 1.0, 2.0]])
    hits = approximate.nearest_in_cells(indexed, cells, asked, 2, 8, "l2", {"area": "north"}, (), {"$contains": "path"})
    exact = nearest_batch(eight, asked, 8, "l2", {"area": "north"}, {"$contains": "path"}, ())
    assert rows(hits) == rows(exact) and hits.count() > 0


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_calibrated_projections(clustered, far_apart, metric):
    """On clustered vectors most of what is near is found with a fraction of all distances."""
    model = hashing.calibrate(clustered, 16, metric, 5, wanted=0.95, most=0.3)
    found = hashing.search_buckets(clustered, model, far_apart, 16, 5, metric)
    report = approximate.recall(found.ranked(5, metric), nearest_batch(clustered, far_apart, 5, metric, include=())).collect()
    assert sum(r["found"] for r in report) / sum(r["k"] for r in report) >= 0.85
    compared = found.compared.agg(F.sum("compared")).first()[0]
    assert compared < 0.45 * 600 * 20
    assert compared / (600 * 20) == pytest.approx(model.expected_share, abs=0.15)


def test_projections_with_all_buckets_and_differences_are_exact(clustered, questions):
    model = hashing.calibrate(clustered, 16, "l2", 5)
    model = model._replace(prefix=3, buckets=8, radius=model.planes.shape[1])
    exact = nearest_batch(clustered, questions, 5, "l2", include=())
    assert rows(hashing.nearest_in_buckets(clustered, model, questions, 16, 5, "l2")) == rows(exact)


def test_probe_order_is_by_cost():
    signs = np.array([[0.1, -2.0, 0.5], [-3.0, 0.2, 0.1]])
    order = hashing.probe_order(signs, 3, 8)
    for row, own in zip(signs, order):
        home = int((row > 0) @ np.array([1, 2, 4]))
        costs = [sum(row[b] ** 2 for b in range(3) if (cell ^ home) >> b & 1) for cell in own]
        assert sorted(own) == list(range(8)) and costs == sorted(costs) and own[0] == home


@pytest.mark.parametrize("metric", ["l2", "cosine", "inner_product"])
def test_codes(clustered, questions, metric):
    books = quantised.train_codebooks(clustered, 16, 8, metric)
    coded = quantised.with_codes(clustered, books, 16, metric).select("_id", "codes")
    assert {len(r["codes"]) for r in coded.collect()} == {8}
    exact = nearest_batch(clustered, questions, 5, metric, include=())
    report = approximate.recall(quantised.nearest_in_codes(coded, clustered, books, questions, 5, 40, metric), exact).collect()
    assert sum(r["found"] for r in report) / sum(r["k"] for r in report) >= 0.9
    # all records ranked again are the exact answer
    assert rows(quantised.nearest_in_codes(coded, clustered, books, questions, 5, 600, metric)) == rows(exact)


def test_lower_bound_of_a_share():
    assert approximate.lower_bound(0, 10, 0.05) == 0
    # 20 of 20: p ** 20 = 0.05
    assert approximate.lower_bound(20, 20, 0.05) == pytest.approx(0.05 ** (1 / 20), abs=1e-9)
    from math import comb

    bound = approximate.lower_bound(37, 50, 0.05)
    assert sum(comb(50, i) * bound**i * (1 - bound) ** (50 - i) for i in range(37, 51)) == pytest.approx(0.05, abs=1e-9)


def test_probes_for_a_wanted_recall(clustered, questions):
    cells = approximate.train_cells(clustered, 8, 16, "l2")
    indexed = approximate.build_cells(clustered, cells, 16, "l2").cache()
    table = {r["probes"]: r for r in approximate.probes_needed(indexed, cells, questions, 5, "l2").collect()}
    exact = nearest_batch(clustered, questions, 5, "l2", include=())
    for probes in (1, 3, 8):
        report = approximate.recall(approximate.nearest_in_cells(indexed, cells, questions, probes, 5, "l2"), exact).collect()
        assert table[probes]["found"] == sum(r["found"] for r in report) and table[probes]["neighbours"] == 100
    row = approximate.choose_probes(indexed, cells, questions, 0.7, 5, "l2").first()
    assert row["bound"] >= 0.7 and row["recall"] >= row["bound"] and 1 <= row["probes"] <= 8
    assert approximate.choose_probes(indexed, cells, questions, 0.999, 5, "l2").first()["probes"] == 8


def _tile(model, asked, records):
    return model.run(records, pa.table({"query_id": pa.array(range(len(asked))), "vector": pa.array(list(asked))}))


def test_sketches_of_a_tile_are_compared_together(monkeypatch):
    """Distances are measured for what can enter a list, not for a query at a time; all close sketches are counted."""
    calls, measure, rng = [], nearest._measure, np.random.default_rng(6)
    for module in (nearest, hashing):
        monkeypatch.setattr(module, "_measure", lambda *args: calls.append(1) or measure(*args), raising=False)
    x, asked = rng.normal(size=(3000, 8)), rng.normal(size=(400, 8))
    model = hashing.Projections(rng.normal(size=(8, 64)), np.zeros(8), 0, 1, 30, 1.0, 1.0)
    records = pa.table({"_id": [f"v{i}" for i in range(3000)], "embedding": list(x)})
    _, compared = _tile(hashing.CompareSketches("cosine", 5, 8, model), asked, records)
    a, b = (hashing._signs(v, model, "cosine") > 0 for v in (x, asked))
    assert compared == sum(int(((a != row).sum(axis=1) <= 30).sum()) for row in b)
    assert len(calls) < 400


def test_codes_of_a_tile_tie_by_id():
    rng = np.random.default_rng(6)
    books = quantised.Codebooks([rng.normal(size=(256, 2)) for _ in range(4)], [0, 2, 4, 6, 8])
    codes = np.repeat(rng.integers(0, 256, (40, 4)), 50, axis=0).astype(np.uint8)
    names = [f"v{i:04}" for i in rng.permutation(2000)]
    lists, compared = _tile(quantised.CompareCodes("l2", 30, 8, books), asked := rng.normal(size=(20, 8)), pa.table({"_id": names, "codes": [c.tobytes() for c in codes]}))
    found = pa.Table.from_batches(lists.batches(pa.int64(), ["query_id", "_id", "distance"])).to_pandas()
    assert compared == 2000 * 20
    for q, query in enumerate(asked):
        cost = sum(((query[2 * p : 2 * p + 2] - books.centres[p][codes[:, p]]) ** 2).sum(axis=1) for p in range(4))
        best = [names[i] for i in np.lexsort((names, nearest.steady(cost)))[:30]]
        assert found[found.query_id == q]._id.tolist() == best


def test_probed_buckets_are_those_of_the_order():
    signs = np.random.default_rng(1).normal(size=(50, 5)).round(1)
    signs[:10, 2] = 0
    for prefix, buckets in ((5, 7), (5, 32), (3, 1), (0, 1)):
        inside = hashing.probed(signs, prefix, buckets)
        assert [set(row) for row in hashing.probe_order(signs, prefix, buckets)] == [set(np.flatnonzero(row)) for row in inside]


def test_a_query_is_sent_to_a_cell_once(clustered, far_apart, monkeypatch):
    """Not once for each of its buckets; what is found and counted is the same for cells of one bucket and of many."""
    model = hashing.calibrate(clustered, 16, "l2", 5)._replace(prefix=6, buckets=24)
    sent, plain = [], hashing.nearest_in_tiles
    monkeypatch.setattr(hashing, "nearest_in_tiles", lambda records, asked, compare: sent.append(asked.count()) or plain(records, asked, compare))
    found = []
    for size in (tiles.RECORDS, 2):
        monkeypatch.setattr(tiles, "RECORDS", size)
        tiled = hashing.search_buckets(clustered, model, far_apart, 16, 5, "l2")
        found.append((rows(tiled.ranked(5, "l2")), tiled.compared.agg(F.sum("compared")).first()[0]))
    assert found[0] == found[1] and sent == [20, 24 * 20]
