"""Markdown files, answers, and streams."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hybridframe.client import Client, VectorConfiguration
from hybridframe.operators.embed import HashingEmbedder
from hybridframe.plans import answers
from hybridframe.sources.markdown import chunk_records, chunks, read_markdown
from hybridframe.streaming.ingest import deduplicate, ingest_markdown_stream, upsert_stream

FILES = {
    "a.md": "# Title\n\nFirst words.\n\n## Part\n  body of part \n# \n\n# Last",
    "deep/er/b.md": "no header at all\n",
    "c.txt": "# not markdown",
    "blank.md": " \n# \n",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    (tmp_path / "in" / "broken.md").write_bytes(b"# \xff\xfe broken")
    return tmp_path / "in"


def expected(folder):
    found = {}
    for path in sorted(folder.rglob("*.md")):
        try:
            pieces = [p.strip() for p in path.read_text(encoding="utf-8").split("# ") if p.strip()]
        except UnicodeDecodeError:
            continue
        found.update({f"{path}_{i}": p for i, p in enumerate(pieces)})
    return found


def test_sections_of_files(spark, folder):
    records = chunk_records(chunks(read_markdown(spark, str(folder)))).collect()
    assert {r["_id"]: r["document"] for r in records} == expected(folder)
    assert {r["document"] for r in records} == {"Title\n\nFirst words.\n\n#", "Part\n  body of part", "Last", "no header at all"}
    one = chunk_records(chunks(read_markdown(spark, str(folder / "deep/er/b.md")))).collect()
    assert [r["metadata"] for r in one] == [f'{{"source_file":"{folder}/deep/er/b.md","chunk_index":0}}']
    assert read_markdown(spark, str(folder / "c.txt")).count() == 0


def test_long_sections_are_cut_on_request(spark):
    df = spark.createDataFrame([("f", "x" * 9000 + "# y")], "source_file string, text string")
    assert [len(r["text"]) for r in chunks(df).collect()] == [8000, 1000, 1]
    assert [len(r["text"]) for r in chunks(df, max_chars=None).collect()] == [9000, 1]


def test_from_files_to_prompts(spark, folder, tmp_path):
    collection = Client(spark, str(tmp_path / "store")).create_collection("notes")
    answers.ingest(collection, str(folder))
    answers.ingest(collection, str(folder))
    assert {*collection.get()["ids"]} == {*expected(folder)}
    stats = answers.collection_stats(collection.records()).first()
    assert (stats["total_embeddings"], stats["unique_source_files"]) == (4, 2)
    questions = spark.createDataFrame([(0, "body of part"), (1, "header at all")], "query_id int, text string")
    for hybrid in (False, True):
        hits = answers.retrieve_for(collection.records(), questions, HashingEmbedder(), 2, hybrid)
        context = {r["query_id"]: r["context"] for r in answers.contexts(hits).collect()}
        assert context[0].startswith("Part\n  body of part") and context[1].startswith("no header at all")
    prompts = answers.prompts(answers.contexts(hits), questions).collect()
    assert all("Question: " in r["prompt"] and r["system"] for r in prompts)
    shown = answers.display(hits).filter("query_id = 1 and rank = 1").first()
    assert shown["file_name"] == "b.md" and shown["preview"] == "no header at all"


def test_preview_and_file_name(spark):
    df = spark.createDataFrame([("x" * 200, "/a/b.md"), ("x" * 201, "b.md")], "t string, p string")
    rows = df.select(answers.preview(F.col("t")), answers.file_name(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [("x" * 200, "b.md"), ("x" * 200 + "...", "b.md")]


def test_markdown_stream(spark, folder, tmp_path):
    collection = Client(spark, str(tmp_path / "store")).create_collection("notes", embedding_function=HashingEmbedder(16))
    checkpoint = str(tmp_path / "checkpoint")
    ingest_markdown_stream(spark, str(folder), collection, checkpoint, once=True).awaitTermination()
    assert {*collection.get()["ids"]} == {*expected(folder)}
    (folder / "new.md").write_text("# Later")
    ingest_markdown_stream(spark, str(folder), collection, checkpoint, once=True).awaitTermination()
    assert {*collection.get()["ids"]} == {*expected(folder)} and collection.count() == 5


def test_a_replayed_batch_is_applied_once(spark, tmp_path):
    collection = Client(spark, str(tmp_path)).create_collection("c", VectorConfiguration(1), None)

    def batch(text):
        return spark.createDataFrame([("a", text, [1.0])], "_id string, document string, embedding array<float>")

    assert collection.upsert_frame(batch("one"), "s", 0)
    assert not collection.upsert_frame(batch("again"), "s", 0)
    assert collection.upsert_frame(batch("other stream"), "t", 0)
    assert collection.upsert_frame(batch("two"), "s", 1)
    assert collection.get("a")["documents"] == ["two"]


def test_stream_of_changes_in_several_batches(spark, tmp_path):
    source = tmp_path / "source"
    for i in range(3):
        rows = [(f"k{j}", f"batch {i}", [float(i)]) for j in range(i, i + 3)]
        spark.createDataFrame(rows, "_id string, document string, embedding array<float>").coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema("_id string, document string, embedding array<float>").option("maxFilesPerTrigger", 1).parquet(str(source))
    collection = Client(spark, str(tmp_path / "store")).create_collection("c", VectorConfiguration(1), None, buckets=2)
    upsert_stream(stream, collection, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    got = dict(zip(collection.get()["ids"], collection.get()["documents"]))
    assert got == {"k0": "batch 0", "k1": "batch 1", "k2": "batch 2", "k3": "batch 2", "k4": "batch 2"}
    assert collection._version().streams == {"stream": 2}


def test_deduplication(spark, tmp_path):
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:05:00"), ("b", "2024-01-01 00:06:00"), ("a", "2024-01-01 00:07:00")]
    spark.createDataFrame(rows, "k string, t string").selectExpr("k", "cast(t as timestamp) t").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t timestamp").parquet(str(tmp_path / "in"))
    query = deduplicate(stream, ["k"], "t").writeStream.format("memory").queryName("deduplicated").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["k"] for r in spark.table("deduplicated").collect()) == ["a", "b"]
