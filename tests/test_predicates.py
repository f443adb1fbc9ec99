"""Filters: the truth table of every operator over every kind of value, and what is refused."""

from __future__ import annotations

import pytest
from helpers import frame, ids
from pyspark.sql import functions as F

from hybridframe.functions.predicates import (
    contained_terms,
    only_contains,
    pushdown,
    selection,
    variant_path,
    where_document,
    where_json,
    where_variant,
)

VALUES = {
    "number": '{"k": 5}',
    "decimal": '{"k": 5.5}',
    "string": '{"k": "5"}',
    "true": '{"k": true}',
    "null": '{"k": null}',
    "missing": "{}",
    "object": '{"k": {"x": 1}}',
    "array": '{"k": [5]}',
    "no metadata": None,
    "no json": "k=5",
}
UNKNOWN = {"null", "missing", "no metadata", "no json"}

# filter -> the kinds of value for which it is true; it is NULL for UNKNOWN and false for the others.
TRUTH = [
    ({"k": 5}, {"number"}),
    ({"k": {"$eq": 5}}, {"number"}),
    ({"k": 5.0}, {"number"}),
    ({"k": "5"}, {"string"}),
    ({"k": True}, {"true"}),
    ({"k": False}, set()),
    ({"k": 1}, set()),
    ({"k": {"$ne": 5}}, {"decimal", "string", "true", "object", "array"}),
    ({"k": {"$ne": "5"}}, {"number", "decimal", "true", "object", "array"}),
    ({"k": {"$gt": 5}}, {"decimal"}),
    ({"k": {"$gte": 5}}, {"number", "decimal"}),
    ({"k": {"$lt": 5.5}}, {"number"}),
    ({"k": {"$lte": 5.5}}, {"number", "decimal"}),
    ({"k": {"$lt": "6"}}, {"string"}),
    ({"k": {"$gt": "6"}}, set()),
    ({"k": {"$in": [5, "5"]}}, {"number", "string"}),
    ({"k": {"$in": [True, 5.5]}}, {"true", "decimal"}),
    ({"k": {"$nin": [5, "5"]}}, {"decimal", "true", "object", "array"}),
    ({"k": {"$nin": []}}, {"number", "decimal", "string", "true", "object", "array"}),
    ({"$not": {"k": 5}}, {"decimal", "string", "true", "object", "array"}),
    ({"k": {"$gte": 5, "$lt": 5.2}}, {"number"}),
    ({"k": {"$gte": 5, "$eq": 5.5}}, {"decimal"}),
    ({"$and": [{"k": {"$gte": 5}}, {"k": {"$ne": 5}}]}, {"decimal"}),
    ({"$or": [{"k": 5}, {"k": "5"}]}, {"number", "string"}),
    ({"$or": [{"k": 5}], "k": 5.5}, set()),
    ({"$not": {"k": {"$in": [5]}}, "k": {"$lt": 9}}, {"decimal"}),
]


@pytest.mark.parametrize("where, true", TRUTH, ids=[str(t[0]) for t in TRUTH])
@pytest.mark.parametrize("stored", ["json", "variant"])
def test_truth_table(spark, where, true, stored):
    df = spark.createDataFrame(list(VALUES.items()), "kind string, metadata string")
    if stored == "json":
        test = where_json(where, F.col("metadata"))
    else:
        df = df.withColumn("v", F.try_parse_json("metadata"))
        test = where_variant(where, F.col("v"))
    verdicts = {row["kind"]: row["verdict"] for row in df.select("kind", test.alias("verdict")).collect()}
    expected = {kind: None if kind in UNKNOWN else kind in true for kind in VALUES}
    assert verdicts == expected


def test_empty_filters(five):
    assert ids(five.filter(selection())) == {"r1", "r2", "r3", "r4", "r5"}
    assert ids(five.filter(selection({}, {}))) == {"r1", "r2", "r3", "r4", "r5"}
    assert ids(five.filter(selection({"room": {"$in": []}}))) == set()
    assert ids(five.filter(selection({"room": None}))) == set()


@pytest.mark.parametrize("where", [{"$and": []}, {"$or": []}, {"room": {}}, {"$not": {}}, {"$and": [{}]}, {"$or": [{"room": "tent"}, {}]}])
def test_filters_that_say_nothing_are_refused(where):
    with pytest.raises(ValueError):
        selection(where)


@pytest.mark.parametrize("where", [{"$and": []}, {"$or": []}, {"$or": [{}]}])
def test_text_filters_that_say_nothing_are_refused(where):
    with pytest.raises(ValueError):
        selection(None, where)


def test_fixture_filters(five):
    assert ids(five.filter(selection({"kind": "kettle"}))) == {"r1", "r5"}
    assert ids(five.filter(selection({"price": {"$lt": 48}}))) == {"r2", "r5"}
    assert ids(five.filter(selection({"room": {"$nin": ["kitchen", "attic"]}}))) == {"r2", "r4", "r5"}
    assert ids(five.filter(selection({"$or": [{"kind": "pan"}, {"kind": "kettle", "price": {"$gt": 30}}]}))) == {"r1", "r3"}
    assert ids(five.filter(selection(None, {"$regex": "[Gg]reen( wool)?"}))) == {"r2", "r4"}
    assert ids(five.filter(selection(None, {"$contains": "COPPER litres"}))) == {"r1", "r3", "r5"}
    assert ids(five.filter(selection({"room": "kitchen"}, {"$contains": "lid"}, ["r1", "r3"]))) == {"r3"}


def test_paths(spark):
    assert variant_path("a.b") == "$.a.b"
    assert variant_path("a b") == "$['a b']"
    assert variant_path("tags[1]") == "$.tags[1]"
    df = frame(spark, [("1", None, None, {"a": {"b": 1}, "t": [7, 8], "x y": 2, "it's": 3, "d-e": 4})])
    for where in ({"a.b": 1}, {"t[1]": 8}, {"x y": 2}, {"it's": 3}, {"d-e": 4}):
        assert ids(df.filter(selection(where))) == {"1"}, where
    assert ids(df.filter(selection({"a.c": {"$ne": 1}}))) == set()


def test_big_integers_compare_exactly(spark):
    big = 2**53
    df = frame(spark, [("1", None, None, {"k": big}), ("2", None, None, {"k": big + 1})])
    assert ids(df.filter(selection({"k": big + 1}))) == {"2"}
    assert ids(df.filter(selection({"k": {"$lt": 2**70}}))) == {"1", "2"}


@pytest.mark.parametrize(
    "where",
    [{"k": {"$like": 1}}, {"$nor": []}, {"k": {"$in": 3}}, {"$and": {"k": 1}}, {"k": [1]}, {"k": {"$gt": {}}}, ["k"]],
    ids=str,
)
def test_unknown_metadata_operators_are_refused(where):
    with pytest.raises(ValueError):
        where_json(where, F.col("metadata"))


@pytest.mark.parametrize("where", [{"$like": "x"}, {"text": "x"}, {"$or": "x"}, 5], ids=str)
def test_unknown_document_operators_are_refused(where):
    with pytest.raises(ValueError):
        where_document(where, F.col("document"))


def test_document_filters(spark):
    df = frame(spark, [("1", "The quick brown fox", None, None), ("2", "quick-silver; FOX!", None, None), ("3", None, None, None), ("4", "", None, None)])

    def found(where, mode="terms"):
        return ids(df.filter(where_document(where, F.col("document"), mode)))

    assert found({"$contains": "fox"}) == {"1", "2"}
    assert found("silver wolf") == {"2"}
    assert found({"$contains": "quic"}) == set()
    assert found({"$contains": "quic"}, "substring") == {"1", "2"}
    assert found({"$contains": "k b"}, "substring") == {"1"}
    assert found({"$contains": "!?"}) == set()
    assert found({"$regex": "^The"}) == {"1"}
    assert found({"$and": [{"$contains": "quick"}, {"$or": [{"$regex": "brown"}, {"$contains": "zebra"}]}]}) == {"1"}
    assert found({"$contains": "fox", "$regex": "silver"}) == {"2"}
    verdicts = df.select("_id", where_document({"$contains": "fox"}, F.col("document")).alias("v")).collect()
    assert {row["_id"]: row["v"] for row in verdicts} == {"1": True, "2": True, "3": None, "4": False}


def test_terms_of_a_filter():
    where = {"$and": [{"$contains": "b a"}, {"$or": [{"$contains": "A c"}, {"$regex": "d"}]}]}
    assert contained_terms(where) == ["b", "a", "c"]
    assert not only_contains(where)
    assert only_contains({"$or": [{"$contains": "x"}, {"$and": [{"$contains": "y"}]}]})


def test_pushdown_changes_no_result(spark):
    df = frame(spark, [(str(i), None, None, {"k": value}) for i, value in enumerate([1, 5, "5", None, True, 9])])
    typed = df.withColumn("k", F.expr("try_cast(get_json_object(metadata, '$.k') as double)"))
    for where in ({"k": {"$gte": 5}}, {"$and": [{"k": {"$in": [1, 9]}}, {"k": {"$ne": 1}}]}, {"$not": {"k": 5}}, {"$or": [{"k": 1}]}):
        plain = ids(df.filter(selection(where)))
        assert ids(typed.filter(selection(where, typed={"k": (F.col("k"), "number")}))) == plain, where
    assert pushdown({"$not": {"k": 5}}, {"k": (F.col("k"), "number")}) is None
    assert pushdown({"k": {"$ne": 5}}, {"k": (F.col("k"), "number")}) is None
