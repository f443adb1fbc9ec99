from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hybridframe.operators.embed import HashingEmbedder, dimension_of, embed, embed_missing, embedding, wrong_size


def lengths():
    """An embedding function that refuses batches that are too large."""

    def call(texts):
        if len(texts) > 4:
            raise RuntimeError("batch too large")
        return [[float(len(t)), 1.0] for t in texts]

    return call


@pytest.mark.parametrize("portable", [False, True])
def test_hashing_is_the_same_in_python_and_on_spark(spark, portable):
    texts = ["The cat and the hat", "", "ünïcode Ünïcode 42", "a " * 500, None]
    embedder = HashingEmbedder(32, portable)
    df = embed(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, document string"), embedder)
    made = {r["i"]: r["embedding"] for r in df.collect()}
    for i, text in enumerate(texts[:-1]):
        assert np.allclose(made[i], embedder(text)[0], atol=1e-6)
        assert len(made[i]) == 32
    assert made[4] is None
    assert np.linalg.norm(made[0]) == pytest.approx(1) and not any(made[1])
    assert embedder([]) == [] and len(embedder("one text")) == 1


def test_functions_are_called_in_batches_and_not_for_nulls(spark):
    rows = [(i, None if i % 5 == 0 else "x" * i) for i in range(50)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(3)
    made = df.select("i", "t", embedding(F.col("t"), lengths(), batch_size=4).alias("v")).collect()
    assert all(r["v"] == (None if r["t"] is None else [float(r["i"]), 1.0]) for r in made)
    with pytest.raises(Exception, match="batch too large"):
        df.select(embedding(F.col("t"), lengths(), batch_size=5).alias("v")).collect()


def test_only_missing_vectors_are_made(spark):
    df = spark.createDataFrame([("abc", [9.0, 9.0]), ("ab", None), (None, None)], "document string, embedding array<float>")
    assert [r["embedding"] for r in embed_missing(df, lengths()).collect()] == [[9.0, 9.0], [2.0, 1.0], None]


def test_a_vector_column_can_be_exploded(spark):
    df = embed(spark.createDataFrame([("abc",)], "document string"), lengths()).select(F.explode("embedding").alias("x"))
    assert [r["x"] for r in df.filter("x > 1").collect()] == [3.0]


def test_dimensions(spark):
    assert dimension_of(HashingEmbedder(7)) == 7 and dimension_of(lengths()) == 2
    with pytest.raises(ValueError):
        dimension_of(lambda texts: [])
    with pytest.raises(ValueError):
        HashingEmbedder(0)
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, None)], "i int, embedding array<float>")
    assert [r["i"] for r in wrong_size(df, 2).collect()] == [1]
