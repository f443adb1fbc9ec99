"""Keyed changes: the records that a collection holds after each."""

from __future__ import annotations

from pyspark.sql import functions as F

from hybridframe.client import Client, VectorConfiguration
from hybridframe.operators import mutate
from hybridframe.plans.registry import RECORDS, has_any, query
from hybridframe.plans.session import shared_folder
from hybridframe.plans.standard import records, table
from hybridframe.schema import FIELDS

STATE = ["_id", "document", "metadata"]

# The records and a batch of changes made from the labels: every third label moves to an id that no
# document has; toxic entries bring no text, and good ones no metadata.
BATCH = """
b AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 'n' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS _id,
    CASE WHEN toxic = 0 THEN 'label ' || quality END AS document,
    CASE WHEN quality = 0 THEN '{"toxic":' || toxic || '}' END AS metadata FROM labels)"""


def label_batch(spark, sf):
    ident = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("n"), F.col("doc_id"))).otherwise(F.col("doc_id").cast("string"))
    return table(spark, sf, "labels").select(
        ident.alias("_id"),
        F.when(F.col("toxic") == 0, F.concat(F.lit("label "), F.col("quality"))).alias("document"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.when(F.col("quality") == 0, F.to_json(F.struct("toxic"))).alias("metadata"),
    )


UPDATED = "SELECT r._id, coalesce(b.document, r.document) AS document, coalesce(b.metadata, r.metadata) AS metadata FROM r LEFT JOIN b USING (_id)"
UPSERTED = f"{UPDATED} UNION ALL SELECT _id, document, metadata FROM b WHERE _id NOT IN (SELECT _id FROM r)"


@query(
    "add_rows",
    f"WITH {RECORDS} SELECT _id, document, metadata FROM r UNION ALL SELECT 'p' || page_id, url, NULL FROM pages",
)
def add_rows(spark, sf):
    pages = table(spark, sf, "pages").select(F.concat(F.lit("p"), "page_id").alias("_id"), F.col("url").alias("document"))
    return mutate.add(records(spark, sf), pages).select(*STATE)


DUPLICATES = """SELECT _id, count(*) AS in_batch, bool_or(_id IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)) AS stored
    FROM (SELECT CAST(vec_id * 3 AS VARCHAR) AS _id FROM embeddings UNION ALL SELECT CAST(doc_id * 2 AS VARCHAR) FROM labels) GROUP BY _id"""


@query("add_duplicate_report", f"SELECT * FROM ({DUPLICATES}) WHERE in_batch > 1 OR stored")
def add_duplicate_report(spark, sf):
    first = table(spark, sf, "embeddings").select((F.col("vec_id") * 3).cast("string").alias("_id"))
    second = table(spark, sf, "labels").select((F.col("doc_id") * 2).cast("string").alias("_id"))
    return mutate.duplicates(records(spark, sf), first.unionByName(second))


@query("update_fields", f"WITH {RECORDS}, {BATCH} {UPDATED}")
def update_fields(spark, sf):
    return mutate.update(records(spark, sf), label_batch(spark, sf)).select(*STATE)


@query("update_missing_noop", f"WITH {RECORDS} SELECT _id, document, metadata FROM r")
def update_missing_noop(spark, sf):
    strangers = label_batch(spark, sf).withColumn("_id", F.concat(F.lit("x"), "_id"))
    return mutate.update(records(spark, sf), strangers).select(*STATE)


@query("update_missing_ids", f"WITH {RECORDS}, {BATCH} SELECT _id FROM b WHERE _id NOT IN (SELECT _id FROM r)")
def update_missing_ids(spark, sf):
    return mutate.missing(records(spark, sf), label_batch(spark, sf))


@query("upsert_mixed", f"WITH {RECORDS}, {BATCH} {UPSERTED}")
def upsert_mixed(spark, sf):
    return mutate.upsert(records(spark, sf), label_batch(spark, sf)).select(*STATE)


@query("upsert_twice", f"WITH {RECORDS}, {BATCH} {UPSERTED}")
def upsert_twice(spark, sf):
    batch = label_batch(spark, sf)
    return mutate.upsert(mutate.upsert(records(spark, sf), batch), batch).select(*STATE)


# Every event changes the record of its user: errors bring no text, small values no metadata.
FOLDED = """
f AS (SELECT CAST(user_id AS VARCHAR) AS _id,
    arg_max(event_type, event_id) FILTER (WHERE event_type <> 'error') AS document,
    arg_max(props, event_id) FILTER (WHERE value > 50) AS metadata FROM events GROUP BY user_id)"""


def event_batch(events):
    return events.select(
        F.col("user_id").cast("string").alias("_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("document"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.when(F.col("value") > 50, F.col("props")).alias("metadata"),
        F.col("event_id").alias("position"),
    )


@query("upsert_repeated_ids", f"WITH {RECORDS}, {FOLDED}, b AS (SELECT * FROM f) {UPSERTED}")
def upsert_repeated_ids(spark, sf):
    return mutate.upsert(records(spark, sf), event_batch(table(spark, sf, "events"))).select(*STATE)


@query("upsert_empty_text", f"WITH {RECORDS} SELECT _id, CASE WHEN quality IS NULL THEN document ELSE '' END AS document, metadata FROM r")
def upsert_empty_text(spark, sf):
    ids = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("_id"), F.lit("").alias("document"))
    return mutate.upsert(records(spark, sf), ids).select(*STATE)


def _remaining(condition: str) -> str:
    return f"WITH {RECORDS} SELECT _id, document, metadata FROM r WHERE NOT coalesce({condition}, FALSE)"


LABELLED = "_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)"


def _labelled(spark, sf):
    return table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("_id"))


@query("delete_ids", _remaining(LABELLED))
def delete_ids(spark, sf):
    return mutate.delete(records(spark, sf), _labelled(spark, sf)).select(*STATE)


@query("delete_where", _remaining("quality <> 1"))
def delete_where(spark, sf):
    return mutate.delete(records(spark, sf), where={"quality": {"$ne": 1}}).select(*STATE)


@query("delete_doc", _remaining(has_any("document", "nicht", "que")))
def delete_doc(spark, sf):
    return mutate.delete(records(spark, sf), where_document={"$contains": "nicht que"}).select(*STATE)


@query("delete_combined", _remaining(f"({LABELLED} AND toxic = 0 AND {has_any('document', 'the')})"))
def delete_combined(spark, sf):
    return mutate.delete(records(spark, sf), _labelled(spark, sf), {"toxic": 0}, {"$contains": "the"}).select(*STATE)


@query(
    "collection_life",
    f"""WITH {RECORDS}, {BATCH}, u AS ({UPSERTED})
    SELECT _id, document, metadata FROM u WHERE NOT coalesce(CAST(json_extract(metadata, '$.toxic') AS INTEGER) = 1, FALSE)""",
)
def collection_life(spark, sf):
    """The same changes through a stored collection and its versions."""
    client = Client(spark, shared_folder(spark))
    collection = client.create_collection("life", VectorConfiguration(64, "cosine"), None, buckets=8, typed={"toxic": "number"})
    collection.add_frame(records(spark, sf))
    collection.upsert_frame(label_batch(spark, sf))
    collection.delete(where={"toxic": 1})
    return collection.records().select(*STATE)


@query(
    "collection_filtered_scan",
    f"WITH {RECORDS} SELECT _id, document, metadata FROM r WHERE toxic = 0 AND lang = 'en'",
)
def collection_filtered_scan(spark, sf):
    """A stored collection filtered through its typed columns and its parsed metadata."""
    from hybridframe.operators import retrieve

    client = Client(spark, shared_folder(spark))
    collection = client.create_collection("scan", VectorConfiguration(64, "cosine"), None, buckets=8, typed={"toxic": "number", "lang": "string"})
    collection.add_frame(records(spark, sf))
    found = retrieve.select_records(collection._scan(), where={"toxic": 0, "lang": "en"}, **collection._options())
    return retrieve.project(found)


@query("record_fields", f"WITH {RECORDS} SELECT _id, document, metadata, len(embedding) AS size FROM r")
def record_fields(spark, sf):
    return records(spark, sf).select(*FIELDS).withColumn("size", F.size("embedding")).drop("embedding")
