"""Scans, metadata filters, text filters, pages and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hybridframe.functions import records as codecs
from hybridframe.operators import fulltext, lookup, retrieve
from hybridframe.plans.registry import RECORDS, has_any, query
from hybridframe.plans.session import shared_folder
from hybridframe.plans.standard import event_records, records, table
from hybridframe.schema import split_rejects

# --- projections ---


@query("scan_include_default", f"WITH {RECORDS} SELECT _id, document, metadata FROM r")
def scan_include_default(spark, sf):
    return retrieve.project(records(spark, sf))


@query("scan_include_ids", f"WITH {RECORDS} SELECT _id FROM r")
def scan_include_ids(spark, sf):
    return retrieve.project(records(spark, sf), ["ids", "distances"])


@query("scan_include_singular", f"WITH {RECORDS} SELECT _id, document FROM r")
def scan_include_singular(spark, sf):
    return retrieve.project(records(spark, sf), ["document"])


@query("null_metadata", "SELECT CAST(vec_id AS VARCHAR) AS _id, CASE WHEN label > 4 THEN '{\"label\":' || label || '}' ELSE '{}' END AS metadata FROM embeddings")
def null_metadata(spark, sf):
    metadata = F.when(F.col("label") > 4, F.to_json(F.struct("label")))
    df = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("_id"), metadata.alias("metadata"))
    return retrieve.project(df, ["metadatas"])


@query(
    "metadata_parse",
    f"WITH {RECORDS} SELECT _id, n_chars, document AS kept FROM r",
)
def metadata_parse(spark, sf):
    df = records(spark, sf)
    return df.select(
        "_id",
        F.try_variant_get(codecs.parse_metadata(F.col("metadata")), "$.n_chars", "bigint").alias("n_chars"),
        F.try_variant_get(codecs.parse_metadata(F.col("document")), "$", "string").alias("kept"),
    )


@query(
    "vector_codec",
    "SELECT CAST(vec_id AS VARCHAR) AS _id, len(embedding) AS n, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings",
)
def vector_codec(spark, sf):
    df = table(spark, sf, "embeddings").withColumn("back", codecs.vector_from_text(codecs.vector_to_text(F.col("embedding"))))
    total = F.aggregate("back", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return df.select(F.col("vec_id").cast("string").alias("_id"), F.size("back").cast("long").alias("n"), F.round(total, 6).alias("total"))


@query("id_decode", "SELECT doc_id, text AS readable, md5(text) || 'ff' AS unreadable FROM documents")
def id_decode(spark, sf):
    raw = F.unhex(F.concat(F.md5(F.col("text")), F.lit("ff")))
    return table(spark, sf, "documents").select(
        "doc_id",
        codecs.decode_id(F.col("text").cast("binary")).alias("readable"),
        codecs.decode_id(raw).alias("unreadable"),
    )


# --- metadata filters: name, filter, SQL condition over the typed columns ---

META = {
    "meta_eq": ({"lang": {"$eq": "en"}}, "lang = 'en'"),
    "meta_eq_implicit": ({"quality": 1}, "quality = 1"),
    "meta_ne": ({"toxic": {"$ne": 1}}, "toxic <> 1"),
    "meta_gt": ({"n_chars": {"$gt": 1000}}, "n_chars > 1000"),
    "meta_gte": ({"n_chars": {"$gte": 1000.5}}, "n_chars >= 1000.5"),
    "meta_lt": ({"n_chars": {"$lt": 500}}, "n_chars < 500"),
    "meta_lte": ({"lang": {"$lte": "es"}}, "lang <= 'es'"),
    "meta_in": ({"source": {"$in": ["src1", "src3", "src17"]}}, "source IN ('src1', 'src3', 'src17')"),
    "meta_nin": ({"quality": {"$nin": [0, "0"]}}, "quality NOT IN (0)"),
    "meta_in_empty": ({"lang": {"$in": []}}, "FALSE"),
    "meta_nin_empty": ({"quality": {"$nin": []}}, "quality IS NOT NULL"),
    "meta_and": ({"$and": [{"lang": "en"}, {"n_chars": {"$gt": 500}}, {"quality": 1}]}, "lang = 'en' AND n_chars > 500 AND quality = 1"),
    "meta_or": ({"$or": [{"lang": "de"}, {"toxic": 1}]}, "lang = 'de' OR toxic = 1"),
    "meta_not": ({"$not": {"quality": {"$eq": 0}}}, "NOT (quality = 0)"),
    "meta_not_nested": (
        {"$not": {"$or": [{"lang": "en"}, {"$and": [{"quality": 1}, {"toxic": 0}]}]}},
        "NOT (lang = 'en' OR (quality = 1 AND toxic = 0))",
    ),
    "meta_mixed_level": ({"source": "src2", "$or": [{"lang": "fr"}, {"quality": 1}]}, "source = 'src2' AND (lang = 'fr' OR quality = 1)"),
    "meta_multi_op": ({"n_chars": {"$gte": 200, "$lt": 2000, "$ne": 400}}, "n_chars >= 200 AND n_chars < 2000 AND n_chars <> 400"),
    "meta_many_fields": ({"lang": "en", "quality": 1, "toxic": 0}, "lang = 'en' AND quality = 1 AND toxic = 0"),
    "meta_empty": ({}, "TRUE"),
}

for _name, (_where, _condition) in META.items():

    def _filtered(spark, sf, where=_where):
        return retrieve.project(retrieve.select_records(records(spark, sf), where=where), ["metadatas"])

    query(_name, f"WITH {RECORDS} SELECT _id, metadata FROM r WHERE {_condition}")(_filtered)


EVENTS = "e AS (SELECT CAST(event_id AS VARCHAR) AS _id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"


@query("meta_nested_path", f"WITH {EVENTS} SELECT _id FROM e WHERE k >= 50 AND k <> 77")
def meta_nested_path(spark, sf):
    where = {"props.k": {"$gte": 50, "$ne": 77}}
    return retrieve.project(retrieve.select_records(event_records(spark, sf), where=where), ())


@query("meta_type_strict", f"WITH {EVENTS} SELECT _id FROM e WHERE k IS NOT NULL AND k < 30")
def meta_type_strict(spark, sf):
    # A number is never equal to, nor in order with, the string that looks like it.
    where = {"props.k": {"$lt": 30, "$ne": "7"}, "$not": {"$or": [{"props.k": {"$gt": "0"}}, {"props": 5}]}}
    return retrieve.project(retrieve.select_records(event_records(spark, sf), where=where), ())


@query("meta_three_valued", f"WITH {RECORDS} SELECT _id, quality = 1 AS verdict, NOT (quality = 1) AS opposite FROM r")
def meta_three_valued(spark, sf):
    from hybridframe.functions.predicates import where_json

    test = {"quality": 1}
    return records(spark, sf).select(
        "_id",
        where_json(test, F.col("metadata")).alias("verdict"),
        where_json({"$not": test}, F.col("metadata")).alias("opposite"),
    )


# --- text filters ---

TEXT = {
    "doc_match_any": ({"$contains": "Tionerst QUEUES nicht"}, has_any("document", "tionerst", "queues", "nicht"), "terms"),
    "doc_match_string": ("that and", has_any("document", "that", "and"), "terms"),
    "doc_substring": ({"$contains": "the of"}, "contains(document, 'the of')", "substring"),
    "doc_regex": ({"$regex": "[Tt]he (on|of) \\w+"}, "regexp_matches(document, '[Tt]he (on|of) \\w+')", "terms"),
    "doc_regex_fold": ({"$regex": "(?i)NICHT"}, "regexp_matches(document, '(?i)NICHT')", "terms"),
    "doc_and": ({"$and": [{"$contains": "nicht"}, {"$contains": "auch der"}]}, f"{has_any('document', 'nicht')} AND {has_any('document', 'auch', 'der')}", "terms"),
    "doc_and_or": (
        {"$or": [{"$and": [{"$contains": "the"}, {"$regex": "[0-9]{3}"}]}, {"$contains": "que"}]},
        f"({has_any('document', 'the')} AND regexp_matches(document, '[0-9]{{3}}')) OR {has_any('document', 'que')}",
        "terms",
    ),
    "doc_many_keys": ({"$contains": "the", "$regex": "@"}, f"{has_any('document', 'the')} AND regexp_matches(document, '@')", "terms"),
}

for _name, (_where, _condition, _mode) in TEXT.items():

    def _matched(spark, sf, where=_where, mode=_mode):
        return retrieve.project(retrieve.select_records(records(spark, sf), where_document=where, mode=mode), ())

    query(_name, f"WITH {RECORDS} SELECT _id FROM r WHERE {_condition}")(_matched)


@query(
    "page_deep",
    f"""WITH {RECORDS} SELECT _id, metadata FROM (SELECT _id, metadata, row_number() OVER (ORDER BY _id) AS place, count(*) OVER () AS n FROM r)
    WHERE place > n // 2 AND place <= n // 2 + 50""",
)
def page_deep(spark, sf):
    """A page from the middle: of the sorted ids only the ranges that it lies in are read."""
    folder, searched = shared_folder(spark), records(spark, sf)
    retrieve.write_pages(searched, folder)
    return retrieve.deep_page(searched, folder, 50, searched.count() // 2).select("_id", "metadata")


# --- text filters through an index ---


def _indexes(spark, sf, where="$contains $regex", mode=""):
    """The records, and those of the two indexes that a filter can use."""
    folder, searched, terms, grams = shared_folder(spark), records(spark, sf), None, None
    if "$contains" in str(where) and mode != "substring":
        fulltext.write_index(searched, f"{folder}/terms")
        terms = fulltext.read_index(spark, f"{folder}/terms")
    if "$regex" in str(where) or mode == "substring":
        lookup.write_grams(searched, f"{folder}/grams")
        grams = lookup.read_grams(spark, f"{folder}/grams")
    return searched, terms, grams


INDEXED = {name: TEXT[name] for name in ("doc_match_any", "doc_substring", "doc_and", "doc_many_keys")} | {
    "doc_regex": ({"$regex": "[Tt]he of \\w+"}, "regexp_matches(document, '[Tt]he of \\w+')", "terms")
}

for _name, (_where, _condition, _mode) in INDEXED.items():

    def _looked_up(spark, sf, where=_where, mode=_mode):
        searched, terms, grams = _indexes(spark, sf, where, mode)
        return lookup.select_documents(searched, where, terms, grams, mode).select("_id")

    query(f"{_name}_indexed", f"WITH {RECORDS} SELECT _id FROM r WHERE {_condition}")(_looked_up)


@query("doc_texts_read")
def doc_texts_read(spark, sf):
    """``filter, texts, read``: how many texts the filters above are checked on."""
    searched, terms, grams = _indexes(spark, sf)
    parts = [lookup.texts_read(searched, where, terms, grams, mode).select(F.lit(name).alias("filter"), "*") for name, (where, _, mode) in INDEXED.items()]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


# --- retrieval ---


@query("get_by_ids", f"WITH {RECORDS} SELECT _id, metadata FROM r WHERE _id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)")
def get_by_ids(spark, sf):
    ids = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("_id"))
    return retrieve.project(retrieve.select_records(records(spark, sf), ids), ["metadatas"])


@query(
    "get_combined",
    f"WITH {RECORDS} SELECT _id FROM r WHERE _id IN (SELECT CAST(vec_id AS VARCHAR) FROM embeddings) AND lang = 'en' AND {has_any('document', 'the')}",
)
def get_combined(spark, sf):
    ids = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("_id"))
    return retrieve.project(retrieve.select_records(records(spark, sf), ids, {"lang": "en"}, {"$contains": "the"}), ())


@query("get_filter_page", f"WITH {RECORDS} SELECT _id, document FROM r WHERE lang = 'en' ORDER BY _id LIMIT 25 OFFSET 50")
def get_filter_page(spark, sf):
    return retrieve.get(records(spark, sf), where={"lang": "en"}, limit=25, offset=50, include=["documents"])


@query("get_default_page", f"WITH {RECORDS} SELECT _id, document, metadata FROM r ORDER BY _id LIMIT 100")
def get_default_page(spark, sf):
    return retrieve.get(records(spark, sf))


@query("get_page_after", f"WITH {RECORDS} SELECT _id, metadata FROM r WHERE _id > '5' ORDER BY _id LIMIT 40")
def get_page_after(spark, sf):
    return retrieve.page_after(retrieve.project(records(spark, sf), ["metadatas"]), "5", 40)


@query("peek", f"WITH {RECORDS} SELECT _id, document, metadata FROM r ORDER BY _id LIMIT 10")
def peek(spark, sf):
    return retrieve.peek(records(spark, sf)).drop("embedding")


@query("count_rows", f"WITH {RECORDS} SELECT count(*) AS n FROM r")
def count_rows(spark, sf):
    return retrieve.count(records(spark, sf))


@query(
    "describe",
    f"""WITH {RECORDS} SELECT 'documents' AS name, 64 AS dimension, 'cosine' AS distance, count(*) AS n,
    count(*) FILTER (WHERE document IS NULL) AS null_document, count(*) FILTER (WHERE embedding IS NULL) AS null_embedding,
    count(*) FILTER (WHERE metadata IS NULL) AS null_metadata FROM r""",
)
def describe(spark, sf):
    return retrieve.describe(records(spark, sf), "documents", 64, "cosine")


@query(
    "reject_split",
    f"""WITH {RECORDS}, j AS (SELECT CASE WHEN lang = 'es' THEN '' ELSE _id END AS _id, n_chars,
      CASE WHEN lang = 'es' THEN 'empty id' WHEN lang = 'de' AND embedding IS NOT NULL THEN 'wrong vector size'
           WHEN lang = 'fr' THEN 'metadata is not a JSON object' END AS reason FROM r)
    SELECT reason, count(*) AS n FROM j WHERE reason IS NOT NULL GROUP BY reason""",
)
def reject_split(spark, sf):
    lang = F.get_json_object("metadata", "$.lang")
    spoiled = (
        records(spark, sf)
        .withColumn("lang", lang)
        .select(
            F.when(F.col("lang") == "es", F.lit("")).otherwise(F.col("_id")).alias("_id"),
            "document",
            F.when(F.col("lang") == "de", F.slice("embedding", 1, 63)).otherwise(F.col("embedding")).alias("embedding"),
            F.when(F.col("lang") == "fr", F.concat(F.lit("["), "metadata", F.lit("]"))).otherwise(F.col("metadata")).alias("metadata"),
        )
    )
    return split_rejects(spoiled, 64)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
