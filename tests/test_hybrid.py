from __future__ import annotations

import pytest
from helpers import ids, ranked
from pyspark.sql import functions as F

from hybridframe import results
from hybridframe.operators.approximate import CellIndex, build_cells, train_cells
from hybridframe.operators.fulltext import build_index
from hybridframe.operators.hybrid import hybrid_search, reciprocal_rank

Q, R = [0.0, 1.0, 2.0], [5.5, 5.0, 0.0]
TEXT = {"where_document": {"$contains": "forest path"}}


def test_text_leg(eight):
    assert ids(hybrid_search(eight, TEXT)) == {"h1", "h3", "h4", "h6", "h8"}
    both = {"where_document": {"$and": [{"$contains": "forest"}, {"$contains": "path"}]}}
    assert ids(hybrid_search(eight, both)) == {"h1", "h4", "h6", "h8"}
    filtered = {**TEXT, "where": {"metres": {"$lte": 510}}}
    assert ids(hybrid_search(eight, filtered)) == {"h1", "h3", "h6"}


def test_scalar_leg(eight):
    hits = hybrid_search(eight, {"where": {"area": "north", "day": {"$lt": 6}}})
    assert ranked(hits) == ["h1", "h3", "h5"]
    assert {row["score"] for row in hits.collect()} == {1.0}


def test_vector_leg(eight):
    hits = hybrid_search(eight, knn={"query_embeddings": Q, "n_results": 5}, metric="l2")
    assert ranked(hits) == ["h1", "h3", "h5", "h6", "h8"]
    filtered = {"query_embeddings": [Q], "where": {"season": {"$in": ["summer", "winter"]}}}
    assert ranked(hybrid_search(eight, knn=filtered, metric="l2")) == ["h8", "h4", "h2", "h7"]


def test_fusion_by_hand(eight):
    hits = hybrid_search(
        eight, TEXT, {"query_embeddings": Q, "n_results": 5}, {"rrf": {"rank_window_size": 60, "rank_constant": 60}}, 8, metric="l2"
    )
    text = {i: r + 1 for r, i in enumerate(ranked(hybrid_search(eight, TEXT)))}
    near = {i: r + 1 for r, i in enumerate(["h1", "h3", "h5", "h6", "h8"])}
    expected = {i: round(sum(1 / (60 + leg[i]) for leg in (text, near) if i in leg), 9) for i in {*text, *near}}
    rows = hits.collect()
    assert {row["_id"]: row["score"] for row in rows} == pytest.approx(expected)
    assert all(row["text_rank"] == text.get(row["_id"]) and row["knn_rank"] == near.get(row["_id"]) for row in rows)
    assert ranked(hits) == sorted(expected, key=lambda i: (-expected[i], i))
    by_default = hybrid_search(eight, TEXT, {"query_embeddings": Q, "n_results": 5}, None, 8, metric="l2")
    assert sorted(map(tuple, by_default.collect())) == sorted(map(tuple, rows))


def test_legs_filter_on_their_own(eight):
    hits = hybrid_search(
        eight,
        {**TEXT, "where": {"season": "spring", "day": {"$ne": 6}}},
        {"query_embeddings": Q, "where": {"$not": {"$or": [{"area": "south"}, {"metres": {"$lt": 350}}]}}, "n_results": 10},
        {"rrf": {}},
        10,
        metric="l2",
    ).collect()
    assert {r["_id"] for r in hits if r["text_rank"]} == {"h1", "h3"}
    assert {r["_id"] for r in hits if r["knn_rank"]} == {"h1", "h3", "h6", "h8"}


def test_filters_of_both_legs_are_different(eight):
    text = {"where_document": {"$and": [{"$contains": "ridge"}, {"$regex": "walk|line"}]}, "where": {"$or": [{"day": 2}, {"day": 8}]}}
    near = {"query_embeddings": R, "where": {"season": "summer", "metres": {"$lt": 1800}}}
    hits = {r["_id"]: (r["text_rank"], r["knn_rank"]) for r in hybrid_search(eight, text, near, {"rrf": {}}, 5, metric="l2").collect()}
    assert hits == {"h2": (1, None), "h7": (None, 1), "h4": (None, 2)}


def test_fusion_is_symmetric(spark):
    a = spark.createDataFrame([(0, "x", 1), (0, "y", 2)], "query_id int, _id string, rank int")
    b = spark.createDataFrame([(0, "y", 1), (0, "z", 2)], "query_id int, _id string, rank int")
    one = reciprocal_rank({"a": a, "b": b}, 10).select("rank", "_id", "score").collect()
    two = reciprocal_rank({"b": b, "a": a}, 10).select("rank", "_id", "score").collect()
    assert sorted(one) == sorted(two) and one[0]["_id"] == "y"
    assert reciprocal_rank({"a": a, "b": b}, 10, window=1).count() == 2


def test_candidates_of_the_text_leg(eight):
    hits = hybrid_search(eight, {**TEXT, "n_results": 2}, {"query_embeddings": Q, "n_results": 1}, n_results=8, metric="l2")
    assert hits.filter("text_rank is not null").count() == 2


def test_regex_in_the_text_leg(eight):
    assert ids(hybrid_search(eight, {"where_document": {"$regex": "^(Bare|Ridge)"}})) == {"h2", "h7"}


def test_several_vectors_share_the_text(eight):
    hits = hybrid_search(eight, TEXT, {"query_embeddings": [Q, R], "n_results": 3}, n_results=4, metric="l2")
    for q, vector in enumerate([Q, R]):
        alone = hybrid_search(eight, TEXT, {"query_embeddings": vector, "n_results": 3}, n_results=4, metric="l2")
        mine = hits.filter(F.col("query_id") == q).drop("query_id").collect()
        assert sorted(map(tuple, mine)) == sorted(map(tuple, alone.drop("query_id").collect()))
    shaped = results.nested_dict(hits, 2, measure="score")
    assert [len(x) for x in shaped["ids"]] == [4, 4] and set(shaped) == {"ids", "distances", "documents", "metadatas"}


def test_texts_and_vectors_per_query(spark, eight):
    texts = spark.createDataFrame([(0, "forest path"), (1, "ridge")], "query_id int, text string")
    vectors = spark.createDataFrame([(0, Q), (1, R)], "query_id int, vector array<double>")
    hits = hybrid_search(eight, {"query_texts": texts}, {"query_embeddings": vectors, "n_results": 3}, n_results=4, metric="l2")
    alone = hybrid_search(eight, {"where_document": "ridge"}, {"query_embeddings": R, "n_results": 3}, n_results=4, metric="l2")
    assert ranked(hits.filter("query_id = 1")) == ranked(alone)


def test_indexes_give_the_same(eight):
    cells = train_cells(eight, 2, 3, "l2")
    index = {"index": build_index(eight), "cells": CellIndex(build_cells(eight, cells, 3, "l2"), cells, 2)}
    query, knn = {**TEXT, "where": {"area": "north"}}, {"query_embeddings": Q, "where": {"metres": {"$gt": 300}}, "n_results": 5}
    plain = hybrid_search(eight, query, knn, n_results=6, metric="l2").collect()
    assert sorted(map(tuple, hybrid_search(eight, query, knn, n_results=6, metric="l2", **index).collect())) == sorted(map(tuple, plain))


def test_nothing_asked_gives_nothing(eight):
    hits = hybrid_search(eight)
    assert hits.count() == 0
    assert results.nested_dict(hits, 1, measure="score") == {"ids": [[]], "distances": [[]], "documents": [[]], "metadatas": [[]]}


def test_refusals(eight):
    with pytest.raises(ValueError):
        hybrid_search(eight, knn={"n_results": 3})
    with pytest.raises(ValueError):
        hybrid_search(eight, knn={"query_texts": ["x"]})
    with pytest.raises(ValueError):
        hybrid_search(eight, TEXT, {"query_embeddings": Q}, {"weights": {}})

    def broken(texts):
        raise RuntimeError("no model")

    with pytest.raises(ValueError, match="no model"):
        hybrid_search(eight, knn={"query_texts": "x"}, embed=broken)
