"""Streams in several batches: late rows, changes out of order, files that change."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hybridframe.client import Client, VectorConfiguration
from hybridframe.operators import mutate
from hybridframe.sources.markdown import chunk_records, chunks, source_of
from hybridframe.streaming.ingest import deduplicate_windows, in_order, ingest_markdown_stream, late_rows, upsert_stream


@pytest.fixture
def arriving(spark, tmp_path):
    """A stream whose n-th batch is the n-th list of rows."""

    def make(batches, schema):
        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    return make


def test_changes_out_of_order(spark, arriving, tmp_path):
    schema = "_id string, document string, embedding array<float>, metadata string, position long"
    batches = [
        [("a", "a5", None, None, 5), ("b", "b1", [1.0, 2.0, 3.0], '{"v":1}', 1)],
        [("a", "a3", None, '{"v":3}', 3), ("b", None, [4.0, 5.0, 6.0], None, 9), ("c", None, None, None, 2)],
        [("a", None, None, '{"v":2}', 2), ("a", "a4", None, None, 4), ("b", "b2", [0.0, 0.0, 1.0], None, 7), ("b", "b8", None, None, 8), ("c", "", None, None, 1)],
    ]
    stream = arriving(batches, schema)
    collection = Client(spark, str(tmp_path / "root")).create_collection("c", VectorConfiguration(3, "l2"), None, buckets=2)
    upsert_stream(stream, collection, str(tmp_path / "checkpoint"), "s", once=True).awaitTermination()
    whole = mutate.upsert(collection.records().limit(0), spark.createDataFrame([row for rows in batches for row in rows], schema))
    key = lambda df: sorted((r["_id"], r["document"], r["embedding"], r["metadata"]) for r in df.collect())
    assert key(collection.records()) == key(whole)
    assert {r["_id"]: r["document"] for r in collection.records().collect()} == {"a": "a5", "b": "b8", "c": ""}


def test_nothing_new_gives_no_row(spark, arriving, tmp_path):
    schema = "_id string, document string, embedding array<float>, metadata string, position long"
    stream = arriving([[("a", "x", None, None, 5)], [("a", "y", None, None, 4)], [("a", "z", None, None, 6)]], schema)
    out = in_order(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
    out.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["document"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["x", "z"]


def test_windows_and_late_rows(spark, arriving, tmp_path):
    start = datetime(2024, 1, 1)
    at = lambda minutes: start + timedelta(minutes=minutes)
    batches = [
        [("a", at(1)), ("a", at(2)), ("a", at(61)), ("b", at(3))],
        [("a", at(50)), ("c", at(130))],  # 50 is in a window that is open: the watermark stands at 51
        [("c", at(131))],
        [("a", at(5)), ("b", at(119)), ("d", at(131))],  # the batch before began at 120: the first two windows are closed
    ]
    stream = arriving(batches, "k string, ts timestamp")
    running = (
        deduplicate_windows(stream, ["k"], "ts", "1 hour", "10 minutes").writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    running.awaitTermination()
    got = sorted((r["k"], r["window_start"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", at(0)), ("a", at(60)), ("b", at(0)), ("c", at(120)), ("d", at(120))]
    assert late_rows(running) == 2


def test_replaced_sources(spark):
    files = lambda rows: chunk_records(chunks(spark.createDataFrame(rows, "source_file string, text string")))
    first = files([("x.md", "# one# two# three"), ("y.md", "# only")]).unionByName(
        spark.createDataFrame([("free", "no file", None, None)], "_id string, document string, embedding array<float>, metadata string")
    )
    got = mutate.replace_sources(first, files([("x.md", "# two# four"), ("z.md", "# new")]), source_of)
    assert sorted((r["_id"], r["document"]) for r in got.collect()) == [
        ("free", "no file"), ("x.md_0", "two"), ("x.md_1", "four"), ("y.md_0", "only"), ("z.md_0", "new")
    ]


def test_a_file_that_comes_again_shorter(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.md").write_text("# one\n# two\n# three\n")
    (tmp_path / "in" / "y.md").write_text("# other\n")
    collection = Client(spark, str(tmp_path / "root")).create_collection("c", VectorConfiguration(3, "l2"), None, buckets=2)
    run = lambda: ingest_markdown_stream(spark, str(tmp_path / "in"), collection, str(tmp_path / "c"), once=True).awaitTermination()
    run()
    assert collection.count() == 4
    shorter = tmp_path / "again.md"
    shorter.write_text("# one\n# second\n")
    batch = chunk_records(chunks(spark.createDataFrame([(str(tmp_path / "in" / "x.md"), "# one\n# second\n")], "source_file string, text string")))
    collection.replace_sources_frame(batch)
    assert sorted(r["document"] for r in collection.records().collect()) == ["one", "other", "second"]
    assert collection.records().filter(F.col("_id").contains("x.md")).count() == 2
