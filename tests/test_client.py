"""Handles: life cycle, dimensions, changes through versions, databases."""

from __future__ import annotations

import json

import pytest
from helpers import EIGHT, FIVE, frame
from pyspark.sql import functions as F

from hybridframe.client import AdminClient, Client, VectorConfiguration
from hybridframe.operators.embed import HashingEmbedder
from hybridframe.sources.store import ChangeConflict, physical_name


def three():
    """An embedding function of this test alone, so that workers get it by value."""

    def call(texts):
        return [[float(len(t)), float(t.count("a")), 1.0] for t in ([texts] if isinstance(texts, str) else texts)]

    return call


@pytest.fixture
def client(spark, tmp_path):
    return Client(spark, str(tmp_path))


def fill(collection, rows=FIVE):
    collection.add(
        [r[0] for r in rows], documents=[r[1] for r in rows], embeddings=[r[2] for r in rows], metadatas=[r[3] for r in rows]
    )
    return collection


@pytest.fixture
def five_records(client):
    return fill(client.create_collection("five", VectorConfiguration(3, "l2"), None, buckets=4))


# --- life cycle ---


def test_life_cycle(client):
    assert client.list_collections() == [] and client.count_collection() == 0
    made = client.create_collection("docs v1", VectorConfiguration(128, "cosine"), None)
    assert (made.name, made.dimension, made.distance, made.embedding_function) == ("docs v1", 128, "cosine", None)
    assert made.id == physical_name("docs v1") and made.metadata == {"dimension": 128, "distance": "cosine"}
    assert made.count() == 0 and made.peek()["ids"] == []
    with pytest.raises(ValueError):
        client.create_collection("docs v1", VectorConfiguration(128), None)
    assert client.has_collection("docs v1") and not client.has_collection("docs")
    again = client.get_or_create_collection("docs v1", VectorConfiguration(7, "l2"), None)
    assert (again.dimension, again.distance) == (128, "cosine")
    client.get_or_create_collection("other", VectorConfiguration(2), None)
    assert sorted(c.name for c in client.list_collections()) == ["docs v1", "other"] and client.count_collection() == 2
    client.delete_collection("docs v1")
    assert not client.has_collection("docs v1")
    for missing in (client.get_collection, client.delete_collection):
        with pytest.raises(ValueError):
            missing("docs v1")


def test_records_of_the_life_cycle(client):
    collection = client.create_collection("c", VectorConfiguration(2), None)
    collection.add(["x", "y", "z"], [[5, 1], [4, 4], [0, 9]], [{"shelf": s} for s in "abb"], ["a red book", "a map", "letters"])
    assert collection.count() == 3
    seen = collection.peek(2)
    assert {len(v) for v in seen.values()} == {2} and set(seen) == {"ids", "documents", "metadatas", "embeddings"}
    info = collection.describe()
    assert (info["name"], info["dimension"], info["distance"], info["n"]) == ("c", 2, "l2", 3)


def test_unreadable_collections_are_left_out(client):
    client.create_collection("good", VectorConfiguration(2), None)
    client.files.write_new(f"{client.folder}/c_v1_bad/log/000000000000.json", "{")
    with pytest.warns(UserWarning):
        assert [c.name for c in client.list_collections()] == ["good"]


def test_physical_names_do_not_collide():
    names = ["a-b", "a_b", "a b", "a__b", "a_2d_b", "ab", "ä", "_e4_"]
    assert len({physical_name(n) for n in names}) == len(names)
    assert all(physical_name(n).replace("_", "").isalnum() and physical_name(n).isascii() for n in names)


@pytest.mark.parametrize(
    "given, expected",
    [
        ({}, (384, "cosine")),
        ({"embedding_function": None}, (384, "cosine")),
        ({"embedding_function": three()}, (3, "cosine")),
        ({"configuration": None, "embedding_function": HashingEmbedder(128)}, (128, "cosine")),
        ({"configuration": None, "embedding_function": None}, ValueError),
        ({"configuration": VectorConfiguration(9, "inner_product"), "embedding_function": None}, (9, "inner_product")),
        ({"configuration": VectorConfiguration(3), "embedding_function": three()}, (3, "l2")),
        ({"configuration": VectorConfiguration(128), "embedding_function": three()}, ValueError),
        ({"configuration": {"dimension": 3}, "embedding_function": None}, TypeError),
    ],
)
def test_dimensions(client, given, expected):
    if isinstance(expected, type):
        with pytest.raises(expected):
            client.create_collection("c", **given)
    else:
        made = client.create_collection("c", **given)
        assert (made.dimension, made.distance) == expected


def test_configurations_are_checked():
    for bad in ((0, "l2"), (-1, "l2"), (3, "manhattan"), ("3", "l2")):
        with pytest.raises(ValueError):
            VectorConfiguration(*bad)


def test_reopening_attaches_the_default_function(client):
    client.create_collection("c", VectorConfiguration(3), None)
    assert client.get_collection("c").embedding_function.dimension == 384
    assert client.get_collection("c", None).embedding_function is None
    assert client.get_collection("c", given := three()).embedding_function is given


def test_databases(spark, tmp_path):
    admin = AdminClient(spark, str(tmp_path))
    for name in ("b", "a", "c d"):
        admin.create_database(name)
        admin.create_database(name)
    assert admin.list_databases() == ["a", "b", "c d"]
    assert admin.list_databases(1, 1) == ["b"] and admin.list_databases(2) == ["a", "b"]
    assert admin.list_databases(offset=2) == ["a", "b", "c d"]
    assert admin.get_database("c d")["name"] == "c d"
    Client(spark, str(tmp_path), "a").create_collection("x", VectorConfiguration(2), None)
    assert Client(spark, str(tmp_path), "b").count_collection() == 0
    admin.delete_database("a")
    admin.delete_database("a")
    assert admin.list_databases() == ["b", "c d"]
    with pytest.raises(ValueError):
        admin.get_database("a")


# --- changes ---


def test_sequence_of_changes(client):
    c = client.create_collection("c", VectorConfiguration(3, "cosine"), None, buckets=4)
    c.add(["oak", "ash", "elm"], [[7, 0, 1], [1, 8, 3], [2, 2, 9]], [{"row": 4}, {"row": 4}, {"row": 6}])
    c.add("fig", [3.5, 1.5, 0.5], {"row": 1, "height": 2.5}, "Planted beside the south wall")
    assert c.get(["ash", "elm", "oak"])["ids"] == ["ash", "elm", "oak"]
    c.update("fig", metadatas={"row": 2, "pruned": None})
    got = c.get("fig")
    assert got["documents"] == ["Planted beside the south wall"] and got["metadatas"] == [{"row": 2, "pruned": None}]
    c.upsert("fig", documents="Moved into a pot", metadatas={"row": 0}, embeddings=[0.5, 0.5, 8.0])
    got = c.get("fig", include=["documents", "metadatas", "embeddings"])
    assert (got["documents"], got["metadatas"], got["embeddings"]) == (["Moved into a pot"], [{"row": 0}], [[0.5, 0.5, 8.0]])
    c.upsert("yew", [6.0, 6.0, 1.0], {"row": 9}, "Clipped hedge")
    assert c.count() == 5
    c.delete("fig")
    assert c.get()["ids"] == ["ash", "elm", "oak", "yew"]
    c.delete(where_document={"$contains": "hedge"})
    c.delete(where={"row": {"$gt": 5}})
    assert c.get()["ids"] == ["ash", "oak"]
    c.delete(["ash", "nobody"], {"row": 4})
    assert c.get()["ids"] == ["oak"]
    c.delete("oak")
    assert c.count() == 0 and c.get()["ids"] == []


def test_a_failed_add_changes_nothing(five_records):
    before = five_records._store.numbers()
    for ids, vectors in ((["new", "r1"], [[1, 1, 1], [2, 2, 2]]), (["new", "new"], [[1, 1, 1], [2, 2, 2]]), (["new"], [[1, 1]])):
        with pytest.raises(ValueError):
            five_records.add(ids, vectors)
    assert five_records._store.numbers() == before and five_records.count() == 5
    assert five_records._store.files.names(f"{five_records._store.folder}/staging") == []


@pytest.mark.parametrize(
    "method, given",
    [
        ("add", {"ids": "x"}),
        ("add", {"ids": "x", "metadatas": {"a": 1}}),
        ("add", {"ids": "x", "documents": "no function"}),
        ("add", {"ids": ["x", "y"], "embeddings": [[1, 2, 3]]}),
        ("add", {"ids": ["x"], "embeddings": [[1, 2, 3]], "metadatas": [{}, {}]}),
        ("add", {"ids": "", "embeddings": [1, 2, 3]}),
        ("add", {"ids": [], "embeddings": [[1, 2, 3]]}),
        ("update", {"ids": "r1"}),
        ("update", {"ids": [], "metadatas": {"a": 1}}),
        ("update", {"ids": "r1", "documents": "no function"}),
        ("update", {"ids": "x", "metadatas": {"a": 1}, "strict": True}),
        ("upsert", {"ids": "r1"}),
        ("upsert", {"ids": "r1", "documents": "no function"}),
        ("delete", {}),
        ("delete", {"where": {}}),
        ("delete", {"where": {"a": {"$no": 1}}}),
        ("query", {}),
        ("query", {"query_texts": "no function"}),
        ("query", {"query_embeddings": [1, 2, 3], "probes": 2}),
    ],
)
def test_refusals(five_records, method, given):
    with pytest.raises(ValueError):
        getattr(five_records, method)(**given)
    assert five_records.count() == 5


def test_metadata_only_and_unknown_ids(five_records):
    five_records.upsert("bare", metadatas={"a": 1})
    assert five_records.get("bare", include=["documents", "embeddings", "metadatas"]) == {
        "ids": ["bare"], "documents": [None], "embeddings": [None], "metadatas": [{"a": 1}]
    }
    five_records.update("nobody", metadatas={"a": 1})
    assert five_records.get("nobody")["ids"] == []
    assert "bare" not in five_records.query([1, 2, 3], n_results=50)["ids"][0]


def test_numbers_as_ids(client):
    c = client.create_collection("c", VectorConfiguration(1), None)
    c.add([1, 2], [[1.0], [2.0]])
    assert c.get([1, "2"])["ids"] == ["1", "2"]


def test_bad_rows_are_written_aside(spark, client, tmp_path):
    c = client.create_collection("c", VectorConfiguration(2), None)
    c.add("taken", [1.0, 2.0])
    batch = frame(spark, [("good", "a", [1.0, 2.0], None), ("bad", None, [1.0], None), ("taken", None, None, None)])
    assert c.add_valid(batch, str(tmp_path / "rejects")) == 1
    rejects = {r["_id"]: r["reason"] for r in spark.read.parquet(str(tmp_path / "rejects")).collect()}
    assert rejects == {"bad": "wrong vector size", "taken": "id exists already"} and c.count() == 2


def test_only_touched_buckets_are_rewritten(five_records):
    before = five_records._version().folders
    five_records.update("r1", metadatas={"new": 1})
    after = five_records._version().folders
    assert sum(before[b] != after[b] for b in before) == 1


def test_versions_vacuum_and_conflicts(spark, five_records):
    store = five_records._store
    old = store.version()
    five_records.delete("r1")
    assert five_records.records(old.number).count() == 5 and five_records.records().count() == 4
    with pytest.raises(ChangeConflict):
        store.append(old, frame(spark, [("late", None, None, None)]))
    assert five_records.count() == 4
    five_records.vacuum(keep=1)
    assert five_records.count() == 4 and len(store.numbers()) == 1
    used = {v for folders in store.version().folders.values() for v in folders}
    assert {n.removeprefix("v=") for n in store.files.names(f"{store.folder}/data")} == used
    with pytest.raises(ValueError):
        five_records.records(old.number)


def test_typed_keys_reach_parquet(client):
    c = fill(client.create_collection("c", VectorConfiguration(3, "l2"), None, buckets=2, typed={"price": "number", "room": "string"}))
    assert c.get(where={"price": {"$gte": 48}, "room": "kitchen"})["ids"] == ["r1", "r3"]
    plan = c.get_frame(where={"price": {"$gte": 48}})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_typed_c_v1_price,48.0)" in plan


# --- searching ---


def test_query_shapes(five_records):
    one = five_records.query([4.0, 0.0, 1.0], n_results=3)
    assert one["ids"] == [["r1", "r3", "r5"]] and one["distances"][0][:2] == [0.0, 1.0]
    assert set(one) == {"ids", "distances", "documents", "metadatas"}
    many = five_records.query([[4.0, 0.0, 1.0], [0.0, 5.0, 2.0]], n_results=2, include=["embeddings"])
    assert many["ids"] == [["r1", "r3"], ["r2", "r4"]] and set(many) == {"ids", "distances", "embeddings"}
    assert many["embeddings"][1][0] == [0.0, 5.0, 2.0]
    assert set(five_records.query([1, 2, 3], include=[])) == {"ids", "distances"}
    none = five_records.query([1, 2, 3], where={"room": "attic"})
    assert none["ids"] == [[]] and none["documents"] == [[]]
    both = five_records.query([4, 1, 1], where={"kind": "kettle"}, where_document={"$regex": "litres|lid|handle"})
    assert both["ids"] == [["r1", "r5"]]
    assert five_records.query_frame([1, 2, 3], n_results=2).columns[:1] == ["_id"]


def test_query_with_frames(spark, five_records):
    queries = spark.createDataFrame([(0, [4.0, 0.0, 1.5]), (1, [0.0, 4.0, 2.0])], "query_id int, vector array<double>")
    hits = five_records.query_frame(queries, n_results=1)
    assert {(r["query_id"], r["_id"]) for r in hits.collect()} == {(0, "r1"), (1, "r2")}


def test_query_texts(client):
    c = client.create_collection("boats")
    rows = [
        ("a", "Wooden dinghy, two oars, carries three people on calm lakes", {"kind": "rowing", "length": 3}),
        ("b", "Ocean yacht with two masts, six berths and a diesel engine", {"kind": "sailing", "length": 14}),
        ("c", "Coastal yacht with one mast and four berths", {"kind": "sailing", "length": 9}),
        ("d", "Racing catamaran without any berths", {"kind": "sailing", "length": 6}),
    ]
    c.upsert([r[0] for r in rows], documents=[r[1] for r in rows], metadatas=[r[2] for r in rows])
    found = c.query(
        query_texts="where to sleep on a long voyage",
        where={"kind": "sailing", "length": {"$gt": 6}},
        where_document={"$contains": "berths"},
        n_results=3,
    )
    assert set(found["ids"][0]) == {"b", "c"}
    assert c.query(query_texts=[rows[3][1], rows[0][1]], n_results=1)["ids"] == [["d"], ["a"]]
    assert c.query(query_embeddings=c.embedding_function(rows[2][1])[0], query_texts="ignored", n_results=1)["ids"] == [["c"]]


def test_given_vectors_are_kept_and_missing_ones_made(client):
    c = client.create_collection("c", embedding_function=three())
    c.add(["a", "b"], documents=["aaa", "xyz"])
    c.add("v", embeddings=[7.0, 7.0, 7.0], documents="text with its own vector")
    got = c.get(include=["embeddings"])["embeddings"]
    assert got == [[3.0, 3.0, 1.0], [3.0, 0.0, 1.0], [7.0, 7.0, 7.0]]
    c.update("a", documents="banana")
    assert c.get("a", include=["embeddings"])["embeddings"] == [[6.0, 3.0, 1.0]]


def test_hybrid_shapes_and_indexes(client):
    c = fill(client.create_collection("eight", VectorConfiguration(3, "l2"), None, buckets=4), EIGHT)
    query = {"where_document": {"$contains": "forest path"}, "where": {"area": "north"}}
    knn = {"query_embeddings": [0.0, 1.0, 2.0], "n_results": 5}
    plain = c.hybrid_search(query, knn, {"rrf": {}}, 5, ["documents", "metadatas", "embeddings"])
    assert len(plain["ids"][0]) == 5 and set(plain) == {"ids", "distances", "documents", "metadatas", "embeddings"}
    assert plain["distances"][0] == sorted(plain["distances"][0], reverse=True)
    c.build_index(cells=2)
    assert c.hybrid_search(query, knn, {"rrf": {}}, 5, ["documents", "metadatas", "embeddings"], probes=2) == plain
    by_text = c.hybrid_frame(query, n_results=3, include=[])
    assert any("/index/" in path for path in by_text.inputFiles())
    assert "split(lower(document" not in by_text._jdf.queryExecution().executedPlan().toString()
    assert c.query([0.0, 1.0, 2.0], n_results=3, probes=2)["ids"] == [["h1", "h3", "h5"]]
    c.delete("h1")
    assert "h1" not in c.hybrid_search(query, knn)["ids"][0]
    assert c.hybrid_search()["ids"] == [[]]
    assert c.hybrid_search(knn=knn, n_results=1, include=[])["distances"][0][0] == 0.5


def test_indexes_after_changes(client):
    """Text and vector indexes are used after add, update, upsert and delete, and give what a scan gives."""
    c = fill(client.create_collection("eight", VectorConfiguration(3, "l2"), None, buckets=4), EIGHT)
    c.build_index(cells=2)
    c.delete("h1")
    c.update("h3", documents="Gravel road to the old forest mill", embeddings=[0.0, 1.0, 2.5])
    c.upsert(["h9", "h5"], documents=["Forest path and forest road", "Boardwalk, forest and moor"], embeddings=[[0.0, 1.1, 2.0], [1.0, 1.0, 2.0]], metadatas=[{"area": "north"}, {"area": "south"}])
    query, plain = {"where_document": {"$contains": "forest path"}}, client.create_collection("plain", VectorConfiguration(3, "l2"), None, buckets=4)
    plain.add_frame(c.records())
    hits = c.hybrid_frame(query, n_results=8, include=[])
    assert any("/index/" in path for path in hits.inputFiles())
    assert c.hybrid_search(query, n_results=8) == plain.hybrid_search(query, n_results=8)
    near = {"query_embeddings": [[0.0, 1.0, 2.0]], "n_results": 9, "include": ["documents", "metadatas"]}
    assert c.query(**near, probes=2) == plain.query(**near)
    # a text filter together with an approximate search
    for where_document in ({"$contains": "forest"}, {"$regex": "m[io]"}):
        assert c.query(**near, where_document=where_document, probes=2) == plain.query(**near, where_document=where_document)
    texts = {"query_texts": client.spark.createDataFrame([(0, "forest path"), (1, "ridge")], "query_id int, text string")}
    rows = lambda frame: sorted((r["query_id"], r["rank"], r["_id"], round(r["score"], 9)) for r in frame.collect())
    assert rows(c.hybrid_frame(texts, n_results=5, include=[])) == rows(plain.hybrid_frame(texts, n_results=5, include=[]))


def test_sql_over_a_view(client, five_records):
    name = five_records.create_view()
    rows = client.execute(f"SELECT _id FROM {name} WHERE document LIKE :pattern ORDER BY 1", pattern="%opper%").collect()
    assert [r[0] for r in rows] == ["r1", "r3"]


def test_get_by_ids_reads_their_buckets_only(five_records):
    paths = five_records.get_frame(["r1"]).inputFiles()
    assert len({p.split("bucket=")[1].split("/")[0] for p in paths}) == 1


def test_metadata_round_trip(client):
    c = client.create_collection("c", VectorConfiguration(1), None)
    value = {"text": "quote \" and \\ and 'x'", "n": 1.5, "flag": False, "list": [1, {"a": None}], "ünï": "é"}
    c.add("1", [1.0], value, "it's a \"test\"\n100%")
    got = c.get("1")
    assert got["metadatas"] == [value] and got["documents"] == ["it's a \"test\"\n100%"]
    assert c.get(where={"text": value["text"]})["ids"] == ["1"] and json.dumps(got)
    assert c.get_frame(where={"ünï": "é"}).select(F.col("_id")).count() == 1


def test_typed_keys_change_no_result(client):
    big = 2**53
    values = [5, 5.5, big, big + 1, -big - 1, "abc", "5", True, None, 2**63 - 1]
    pair = []
    for name, typed in (("plain", None), ("typed", {"n": "number", "s": "string", "b": "boolean"})):
        c = client.create_collection(name, VectorConfiguration(1), None, typed=typed)
        ids = [str(i) for i in range(len(values))]
        c.add(ids, [[float(i)] for i in range(len(values))], [{"n": v, "s": v, "b": v} for v in values])
        pair.append(c)
    literals = [5, 5.5, big, big + 1, -big - 1, "abc", "5", True, False]
    for key in "nsb":
        for literal in literals:
            for where in ({key: literal}, *({key: {op: literal}} for op in ("$gt", "$gte", "$lt", "$lte", "$ne"))):
                assert pair[0].get(where=where)["ids"] == pair[1].get(where=where)["ids"], where
        where = {key: {"$in": ["abc", 5, True]}}
        assert pair[0].get(where=where)["ids"] == pair[1].get(where=where)["ids"]


def test_repeated_ids_need_an_order(spark, client):
    c = client.create_collection("c", VectorConfiguration(1), None)
    twice = spark.createDataFrame([("a", "old"), ("a", "new")], "_id string, document string").selectExpr(
        "_id", "document", "array(1f) AS embedding", "CAST(NULL AS STRING) AS metadata"
    )
    with pytest.raises(ValueError, match="comes twice"):
        c.overwrite(twice)
    with pytest.raises(Exception, match="position"):
        c.upsert_frame(twice)
    assert c.count() == 0


def test_delete_that_says_nothing_deletes_nothing(client):
    c = client.create_collection("c", VectorConfiguration(1), None)
    c.add(["a", "b"], [[1.0], [2.0]], [{"k": 1}, {"k": 2}], ["x", "y"])
    for arguments in ({"where": {"$or": []}}, {"where": {"k": {}}}, {"where_document": {"$and": []}}):
        with pytest.raises(ValueError):
            c.delete(**arguments)
    c.delete(["a"])
    assert c.get()["ids"] == ["b"]
