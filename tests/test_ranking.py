"""Ranking rests on whole numbers: nothing is lost or reordered because it is small, at any vector size."""

from __future__ import annotations

import pytest
from helpers import frame, ranked

from hybridframe.operators.fulltext import search_text, search_text_batch
from hybridframe.operators.nearest import nearest, nearest_batch, query_frame


@pytest.mark.parametrize("size", [3, 33])
def test_tiny_distances_keep_their_order(spark, size):
    rows = [(name, None, [x] + [0.0] * (size - 1), None) for name, x in (("a", 5e-10), ("b", 1e-10), ("c", 0.0), ("d", 1e-10))]
    assert ranked(nearest(frame(spark, rows), [0.0] * size, 4, "l2")) == ["c", "b", "d", "a"]
    many = nearest_batch(frame(spark, rows), query_frame(spark, [[0.0] * size]), 4, "l2")
    assert ranked(many) == ["c", "b", "d", "a"]


@pytest.mark.parametrize("size", [3, 33])
@pytest.mark.parametrize("metric", ["l2", "cosine", "inner_product"])
def test_vectors_that_are_no_numbers_are_left_out(spark, size, metric):
    rows = [("good", None, [1.0] * size, None), ("bad", None, [float("nan")] * size, None)]
    assert ranked(nearest(frame(spark, rows), [1.0] * size, 5, metric)) == ["good"]


def test_a_term_of_every_document_still_ranks(spark):
    rows = [(f"{i:04}", "the " * (1 + i % 7) + "x" * (i % 3), None, None) for i in range(3000)]
    df = frame(spark, rows)
    alone = search_text(df, {"$contains": "the"}, 5)
    texts = spark.createDataFrame([(0, "the")], "query_id int, text string")
    together = search_text_batch(df, texts, 5)
    assert ranked(alone) == ranked(together) and len(ranked(alone)) == 5
    assert all(row["score"] > 0 for row in alone.collect())
    longest = {row[0] for row in rows if row[1].startswith("the " * 7)}
    assert set(ranked(alone)) <= longest
