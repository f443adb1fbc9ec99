"""Embedding, chunking, retrieval for answers, and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from hybridframe.client import Client, VectorConfiguration
from hybridframe.operators import mutate
from hybridframe.operators.embed import HashingEmbedder, embed, embed_missing, wrong_size
from hybridframe.plans import answers
from hybridframe.plans.change_queries import FOLDED, event_batch
from hybridframe.plans.registry import RECORDS, query
from hybridframe.plans.search_queries import HASH_DIMENSION, K, _whole, text_queries
from hybridframe.plans.session import shared_folder
from hybridframe.plans.standard import records, spread, table
from hybridframe.sources.markdown import chunk_records, chunks, source_of
from hybridframe.streaming.ingest import deduplicate, deduplicate_windows, late_rows, upsert_stream


class LetterCounts:
    """A small embedding function: how often e, n and t occur in a text."""

    dimension = 3

    def __call__(self, texts):
        return [[float(text.count(letter)) for letter in "ent"] for text in texts]


COUNTS = "length(text) - length(replace(text, '{0}', ''))"


@query(
    "embed_function",
    f"SELECT doc_id, CAST({COUNTS.format('e')} AS DOUBLE) AS e, CAST({COUNTS.format('n')} AS DOUBLE) AS n, CAST({COUNTS.format('t')} AS DOUBLE) AS t FROM documents",
)
def embed_function(spark, sf):
    made = embed(spread(table(spark, sf, "documents")).select("doc_id", "text"), LetterCounts(), "text", "vector")
    return made.select("doc_id", *[F.get("vector", F.lit(i)).cast("double").alias(name) for i, name in enumerate("ent")])


@query("embed_dim_check", "SELECT CAST(vec_id AS VARCHAR) AS _id FROM embeddings WHERE label IN (0, 5)")
def embed_dim_check(spark, sf):
    cut = F.when(F.col("label").isin(0, 5), F.slice("embedding", 1, 60)).otherwise(F.col("embedding"))
    df = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("_id"), cut.alias("embedding"))
    return wrong_size(df, 64).select("_id")


@query(
    "embed_missing",
    f"""WITH {RECORDS} SELECT _id, round(CASE WHEN embedding IS NULL THEN CAST({COUNTS.replace('text', 'document').format('e')} AS DOUBLE) ELSE embedding[1] END, 6) AS first FROM r""",
)
def embed_missing_vectors(spark, sf):
    made = embed_missing(records(spark, sf), LetterCounts())
    return made.select("_id", F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first"))


# --- sections ---

CHUNKS = r"""
sections AS (SELECT doc_id, list_filter(list_transform(string_split(text, '# '), lambda c: regexp_replace(c, '^\s+|\s+$', '', 'g')), lambda c: c <> '') AS ss FROM documents),
parts AS (SELECT doc_id, flatten(list_transform(ss, lambda s: list_transform(range(1, length(s) + 1, 8000), lambda i: substr(s, i, 8000)))) AS cs FROM sections),
chunk AS (SELECT doc_id, unnest(range(0, len(cs))) AS chunk_index, unnest(cs) AS text FROM parts)"""


def document_chunks(spark, sf):
    files = spread(table(spark, sf, "documents")).select(F.concat(F.lit("doc"), "doc_id", F.lit(".md")).alias("source_file"), "text")
    return chunks(files)


@query("chunk_sections", f"WITH {CHUNKS} SELECT 'doc' || doc_id || '.md' AS source_file, CAST(chunk_index AS INTEGER) AS chunk_index, text FROM chunk")
def chunk_sections(spark, sf):
    return document_chunks(spark, sf)


@query(
    "chunk_records",
    f"""WITH {CHUNKS} SELECT 'doc' || doc_id || '.md_' || chunk_index AS _id, text AS document,
    '{{"source_file":"doc' || doc_id || '.md","chunk_index":' || chunk_index || '}}' AS metadata FROM chunk""",
)
def chunk_records_of_documents(spark, sf):
    return chunk_records(document_chunks(spark, sf)).drop("embedding")


@query(
    "replace_changed_files",
    f"""WITH {CHUNKS.replace('FROM documents', "FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN substr(text, 1, length(text) // 2) ELSE text END AS text FROM documents)")}
    SELECT 'doc' || doc_id || '.md_' || chunk_index AS _id, text AS document FROM chunk""",
)
def replace_changed_files(spark, sf):
    """A tenth of the files comes again, cut short: their last chunks go."""
    first = chunk_records(document_chunks(spark, sf))
    some = table(spark, sf, "documents").filter(F.col("doc_id") % 10 == 0)
    shorter = some.select(F.concat(F.lit("doc"), "doc_id", F.lit(".md")).alias("source_file"), F.expr("left(text, char_length(text) div 2)").alias("text"))
    return mutate.replace_sources(first, chunk_records(chunks(shorter)), source_of).select("_id", "document")


@query("collection_stats", f"WITH {CHUNKS} SELECT count(*) AS total_embeddings, count(DISTINCT doc_id) AS unique_source_files FROM chunk")
def collection_stats(spark, sf):
    return answers.collection_stats(chunk_records(document_chunks(spark, sf)))


@query(
    "preview",
    "SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS preview, 'doc' || doc_id || '.md' AS file FROM documents",
)
def preview(spark, sf):
    path = F.concat(F.lit("/data/set/doc"), "doc_id", F.lit(".md"))
    return table(spark, sf, "documents").select(
        "doc_id", answers.preview(F.col("text")).alias("preview"), answers.file_name(path).alias("file")
    )


# --- retrieval for answers: every benchmark passage asks, its nearest documents answer ---


def nearest_documents_sql(k: int) -> str:
    """``a(query_id, rank, _id, document)`` by the hashed vectors, from the registered text query."""
    from hybridframe.plans.registry import SQL

    return f"a AS (SELECT n.*, d.text AS document FROM ({SQL['knn_text']}) n JOIN documents d ON n._id = CAST(d.doc_id AS VARCHAR) WHERE rank <= {k})"


def _answers(spark, sf, n, hybrid=False):
    embedder = HashingEmbedder(HASH_DIMENSION, portable=True)
    searched = embed(records(spark, sf).select("_id", "document", "metadata"), embedder)
    return answers.retrieve_for(searched, text_queries(spark, sf), embedder, n, hybrid)


@query(
    "rag_context",
    f"WITH {nearest_documents_sql(5)} SELECT query_id, string_agg(document, chr(10) || chr(10) ORDER BY rank) AS context FROM a GROUP BY query_id",
)
def rag_context(spark, sf):
    return answers.contexts(_answers(spark, sf, 5))


@query(
    "rag_prompt",
    f"""WITH {nearest_documents_sql(3)}, c AS (SELECT query_id, string_agg(document, chr(10) || chr(10) ORDER BY rank) AS context FROM a GROUP BY query_id)
    SELECT query_id, '{answers.SYSTEM_PROMPT}' AS system,
      'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question: ' || b.text || chr(10) || chr(10) || 'Answer:' AS prompt
    FROM c JOIN benchmark b ON b.item_id = c.query_id""",
)
def rag_prompt(spark, sf):
    return answers.prompts(answers.contexts(_answers(spark, sf, 3)), text_queries(spark, sf))


@query(
    "rag_display",
    f"""WITH {nearest_documents_sql(K)} SELECT query_id, rank, distance, 1.0 / (1.0 + distance) AS similarity,
    CASE WHEN length(document) > 200 THEN substr(document, 1, 200) || '...' ELSE document END AS preview FROM a""",
)
def rag_display(spark, sf):
    return answers.display(_answers(spark, sf, K).withColumn("distance", F.round("distance", 9))).drop("file_name").withColumn("rank", _whole("rank"))


def _hybrid_answers_sql() -> str:
    from hybridframe.plans.registry import SQL

    return f"""WITH t AS ({SQL['bm25_batch']}), g AS ({SQL['knn_text']}),
    u AS (SELECT query_id, _id, rank AS text_rank, NULL AS knn_rank FROM t WHERE rank <= 10
      UNION ALL SELECT query_id, _id, NULL, rank FROM g WHERE rank <= 10),
    f AS (SELECT query_id, _id, round(sum(1.0 / (60 + coalesce(text_rank, knn_rank))), 9) AS score,
      max(text_rank) AS text_rank, max(knn_rank) AS knn_rank FROM u GROUP BY query_id, _id),
    n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, _id) AS rank FROM f)
    SELECT query_id, rank, _id, score, text_rank, knn_rank FROM n WHERE rank <= 5"""


@query("rag_hybrid", _hybrid_answers_sql())
def rag_hybrid(spark, sf):
    hits = _answers(spark, sf, 5, hybrid=True)
    return hits.select("query_id", _whole("rank"), "_id", "score", _whole("text_rank"), _whole("knn_rank"))


# --- streams ---


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, sf):
    """First event of every user and type. All events lie within the delay, so each pair comes once."""
    folder = shared_folder(spark)
    timed = event_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    first = deduplicate(timed, ["user_id", "event_type"], "ts", "3650 days").select("user_id", "event_type")
    writer = first.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


WINDOW, DELAY = "6 hours", "2 hours"
# The order in which events arrive: by time in four batches, but every 97th of the first quarter comes with the last one. What is late in a batch
# is decided by the watermark that stood when the batch before it began.
ARRIVAL = """bounds AS (SELECT min(epoch_us(ts)) AS low, greatest(1, max(epoch_us(ts)) - min(epoch_us(ts))) AS span FROM events),
    quartered AS (SELECT events.*, 1 + least(3, (4 * (epoch_us(ts) - low)) // span) AS quarter FROM events, bounds),
    arrived AS (SELECT *, CASE WHEN quarter = 1 AND event_id % 97 = 0 THEN 4 ELSE quarter END AS batch FROM quartered),
    mark AS (SELECT epoch_ms(max(ts)) - 2 * 3600 * 1000 AS late_before FROM arrived WHERE batch < 3),
    timed AS (SELECT *, time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS window_start FROM arrived)"""
IS_LATE = "batch = 4 AND epoch_ms(window_start) + 6 * 3600 * 1000 <= late_before"


def arriving(spark, sf):
    """A stream of the events in four batches, as files that come one after the other."""
    folder, events = shared_folder(spark), table(spark, sf, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    quarter = F.least(F.lit(3), F.expr("4 * (at - low) div span")) + 1
    placed = events.withColumns({"at": at, "low": F.lit(low or 0), "span": F.lit(max(1, (high or 0) - (low or 0)))}).withColumn("quarter", quarter)
    batch = F.when((F.col("quarter") == 1) & (F.col("event_id") % 97 == 0), 4).otherwise(F.col("quarter"))
    for number in range(1, 5):
        placed.filter(batch == number).select(*events.columns).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _windows(spark, sf):
    folder = shared_folder(spark)
    first = deduplicate_windows(arriving(spark, sf), ["user_id", "event_type"], "ts", WINDOW, DELAY)
    writer = first.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.parquet(f"{folder}/out"), running


@query(
    "stream_dedupe_windows",
    f"""WITH {ARRIVAL} SELECT DISTINCT user_id, event_type, CAST(epoch_ms(window_start) AS BIGINT) AS window_start
    FROM timed, mark WHERE NOT ({IS_LATE})""",
)
def stream_dedupe_windows(spark, sf):
    """Users and types once for every six hours of event time; rows that come two hours after the end of their window are too late."""
    return _windows(spark, sf)[0].select("user_id", "event_type", F.unix_millis("window_start").alias("window_start"))


@query("stream_late_rows", f"WITH {ARRIVAL} SELECT count(*) AS late FROM timed, mark WHERE {IS_LATE}")
def stream_late_rows(spark, sf):
    """The rows that were dropped as too late, as Spark counted them."""
    return spark.createDataFrame([(late_rows(_windows(spark, sf)[1]),)], "late long")


@query("stream_out_of_order", f"WITH {FOLDED} SELECT _id, document, metadata FROM f")
def stream_out_of_order(spark, sf):
    """``stream_upsert`` from files in which events come in no order; the collection ends as if they had come in theirs."""
    folder, events = shared_folder(spark), table(spark, sf, "events")
    for number in range(3):
        events.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == number).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    collection = Client(spark, folder).create_collection("users", VectorConfiguration(3, "l2"), None, buckets=8)
    upsert_stream(event_batch(stream), collection, f"{folder}/checkpoint", "events", once=True).awaitTermination()
    return collection.records().select("_id", "document", "metadata")


@query("stream_upsert", f"WITH {FOLDED} SELECT _id, document, metadata FROM f")
def stream_upsert(spark, sf):
    folder = shared_folder(spark)
    collection = Client(spark, folder).create_collection("users", VectorConfiguration(3, "l2"), None, buckets=8)
    upsert_stream(event_batch(event_stream(spark, sf)), collection, f"{folder}/checkpoint", "events", once=True).awaitTermination()
    return collection.records().select("_id", "document", "metadata")
