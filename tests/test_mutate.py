from __future__ import annotations

import json

import pytest
from helpers import frame, ids

from hybridframe.operators import mutate


def state(df):
    return {r["_id"]: (r["document"], r["embedding"], r["metadata"] and json.loads(r["metadata"])) for r in df.collect()}


@pytest.fixture(scope="module")
def three(spark):
    return frame(spark, [("a", "text a", [1.0], {"n": 1, "x": 1}), ("b", "text b", [2.0], {"n": 2}), ("c", None, None, None)])


def test_duplicates(spark, three):
    batch = frame(spark, [("a", None, None, None), ("new", None, None, None), ("new", None, None, None), ("z", None, None, None)])
    assert {tuple(r) for r in mutate.duplicates(three, batch).collect()} == {("a", 1, True), ("new", 2, False)}


def test_update_replaces_given_fields_only(spark, three):
    batch = frame(spark, [("a", None, None, {"n": 9}), ("c", "now", [3.0], None), ("nobody", "x", None, None)])
    after = state(mutate.update(three, batch))
    assert after == {"a": ("text a", [1.0], {"n": 9}), "b": ("text b", [2.0], {"n": 2}), "c": ("now", [3.0], None)}
    assert ids(mutate.missing(three, batch)) == {"nobody"}


def test_upsert_inserts_and_is_idempotent(spark, three):
    batch = frame(spark, [("b", "", None, None), ("d", None, None, {"only": "metadata"})])
    once = mutate.upsert(three, batch)
    assert state(once)["b"] == ("", [2.0], {"n": 2}) and state(once)["d"] == (None, None, {"only": "metadata"})
    assert state(mutate.upsert(once, batch)) == state(once)


def test_repeated_ids_overlay_in_order(spark, three):
    rows = [("a", "one", None, None, 1), ("a", None, [5.0], None, 2), ("a", "three", None, None, 3), ("e", "old", None, '{"v": 1}', 9), ("e", "first", None, None, 4)]
    batch = spark.createDataFrame(rows, "_id string, document string, embedding array<float>, metadata string, position long")
    after = state(mutate.upsert(three, batch))
    assert after["a"] == ("three", [5.0], {"n": 1, "x": 1}) and after["e"] == ("old", None, {"v": 1})


def test_a_hot_id_in_the_batch(spark, three):
    rows = [("hot" if i % 3 == 0 else f"k{i}", f"t{i:04d}", i) for i in range(3000)]
    batch = spark.createDataFrame(rows, "_id string, document string, position long").selectExpr(
        "_id", "document", "cast(null as array<float>) embedding", "cast(null as string) metadata", "position"
    )
    after = state(mutate.upsert(three, batch))
    assert after["hot"][0] == "t2997" and len(after) == 3 + 2000 + 1


def test_delete_keeps_what_is_unknown(spark, three):
    assert ids(mutate.delete(three, where={"n": {"$ne": 1}})) == {"a", "c"}
    assert ids(mutate.delete(three, ids=["a", "zz"])) == {"b", "c"}
    assert ids(mutate.delete(three, "b")) == {"a", "c"}
    assert ids(mutate.delete(three, where_document={"$contains": "text"})) == {"c"}
    assert ids(mutate.delete(three, ["a", "b"], {"n": 1})) == {"b", "c"}
    wanted = three.sparkSession.createDataFrame([("a",), ("c",)], "_id string")
    assert ids(mutate.delete(three, wanted)) == {"b"}
    assert ids(mutate.delete(three, wanted, {"n": 1})) == {"b", "c"}
    assert ids(mutate.selected_for_delete(three, wanted, {"n": 1})) == {"a"}
    for nothing in ({}, {"where": {}}, {"where_document": {}}):
        with pytest.raises(ValueError):
            mutate.delete(three, **nothing)
