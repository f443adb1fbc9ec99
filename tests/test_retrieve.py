from __future__ import annotations

from helpers import frame, ids
from pyspark.sql import functions as F

from hybridframe.functions import records as codecs
from hybridframe.operators import joins, retrieve
from hybridframe.schema import included, split_rejects


def test_include_lists(five):
    assert retrieve.project(five).columns == ["_id", "document", "metadata"]
    assert retrieve.project(five, []).columns == ["_id"]
    assert retrieve.project(five, ["embeddings", "distances", "ids"]).columns == ["_id", "embedding"]
    assert included(["document", "metadata", "embedding"]) == ["document", "embedding", "metadata"]


def test_pages_cover_everything_once(spark):
    df = frame(spark, [(f"id{i:03d}", None, None, None) for i in range(57)])
    pages, after = [], None
    for offset in range(0, 70, 10):
        page = [row["_id"] for row in retrieve.page(df, 10, offset).collect()]
        keyset = [row["_id"] for row in retrieve.page_after(df, after, 10).collect()]
        assert len(page) <= 10 and page == keyset
        pages += page
        after = page[-1] if page else after
    assert pages == sorted(ids(df))
    assert retrieve.get(df).count() == 57
    assert retrieve.get(df, limit=0).count() == 0


def test_ids_as_frame_or_list(five):
    wanted = five.sparkSession.createDataFrame([("r2",), ("r9",), ("r2",)], "_id string")
    assert ids(retrieve.select_records(five, wanted)) == {"r2"}
    assert ids(retrieve.select_records(five, ["r2", "r9"])) == {"r2"}
    assert ids(retrieve.select_records(five, "r4", {"room": "bedroom"})) == {"r4"}


def test_null_metadata_reads_as_empty_object(spark):
    df = frame(spark, [("1", None, None, None)])
    assert retrieve.project(df).first()["metadata"] == "{}"


def test_describe_and_count(spark):
    df = frame(spark, [("1", "a", None, {}), ("2", None, [1.0], None)])
    row = retrieve.describe(df, "n", 1, "l2").first().asDict()
    assert row == {"name": "n", "dimension": 1, "distance": "l2", "n": 2, "null_document": 1, "null_embedding": 1, "null_metadata": 1}
    assert retrieve.count(df).first()["n"] == 2


def test_rejects_name_their_reason(spark):
    nan = float("nan")
    df = frame(
        spark,
        [
            ("ok", "a", [1.0, 2.0], {"a": 1}),
            ("bare", None, None, None),
            ("", "a", None, None),
            ("x" * 513, "a", None, None),
            ("short", None, [1.0], None),
            ("nan", None, [1.0, nan], None),
            ("list", None, None, "[1]"),
            ("text", None, None, "no json"),
        ],
    )
    good, bad = split_rejects(df, 2)
    assert ids(good) == {"ok", "bare"}
    reasons = {row["_id"][:5]: row["reason"] for row in bad.collect()}
    assert reasons["short"] == "wrong vector size" and reasons["nan"] == "vector holds no number"
    assert reasons["list"] == reasons["text"] == "metadata is not a JSON object"
    assert reasons["xxxxx"] == "id too long" and reasons[""] == "empty id"


def test_codecs(spark):
    df = spark.createDataFrame([(bytearray(b"abc"),), (bytearray(b"\xff\x00"),)], "b binary")
    assert [r[0] for r in df.select(codecs.decode_id(F.col("b"))).collect()] == ["abc", "ff00"]
    text = spark.createDataFrame([("[1.0,2.5]",)], "t string").select(codecs.vector_from_text(F.col("t")).alias("v"))
    assert text.first()["v"] == [1.0, 2.5]
    assert text.select(codecs.vector_to_text(F.col("v"))).first()[0] == "[1.0,2.5]"
    parsed = spark.createDataFrame([('{"a": 1}',), ("plain",)], "t string").select(codecs.parse_metadata(F.col("t")).alias("v"))
    assert [r[0] for r in parsed.select(F.expr("try_variant_get(v, '$.a', 'int')")).collect()] == [1, None]
    assert parsed.select(F.expr("try_variant_get(v, '$', 'string')")).collect()[1][0] == "plain"


def test_join_sizes_give_the_same_rows(spark, monkeypatch):
    large = spark.range(1000).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("term"))
    small = spark.createDataFrame([("hot", 1), ("7", 2), ("8", 3)], "term string, w int")
    for how in ("inner", "left_semi", "left", "left_anti"):
        expected = sorted(map(tuple, joins.join_small(large, small, "term", how).collect()), key=repr)
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
        shuffled = joins.join_small(large, small, "term", how, salt_by=F.col("n"))
        assert "_salt" in shuffled._jdf.queryExecution().toString()
        assert sorted(map(tuple, shuffled.collect()), key=repr) == expected
        monkeypatch.undo()
