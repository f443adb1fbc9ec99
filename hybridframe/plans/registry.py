"""Named queries over the test tables, each with SQL for the same result where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridframe.plans.session import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL."""

    def register(run: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            found = run(spark, sf_dir)
            # what is listed is rounded as in the SQL; operators rank by whole numbers
            digits = {"distance": 9, "score": 6 if name.startswith("bm25") or name == "hybrid_text" else 9}
            return found.withColumns({c: F.round(c, digits[c]) for c, kind in found.dtypes if c in digits and kind == "double"})

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = prepared
        if sql is not None:
            SQL[name] = sql
        return run

    return register


# The records of ``plans.standard`` in SQL, with typed columns beside the JSON.
RECORDS = """
r AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS _id, d.text AS document, d.lang, d.source, d.n_chars, l.quality, l.toxic,
         CAST(e.embedding AS DOUBLE[]) AS embedding,
         '{"lang":"' || d.lang || '","source":"' || d.source || '","n_chars":' || d.n_chars
           || coalesce(',"quality":' || l.quality, '') || coalesce(',"toxic":' || l.toxic, '') || '}' AS metadata
  FROM documents d
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN embeddings e ON e.vec_id = d.doc_id
)"""

VECTORS = """
v AS (SELECT CAST(vec_id AS VARCHAR) AS _id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings)"""


def terms_of(text: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"


def has_any(document: str, *terms: str) -> str:
    wanted = ", ".join(f"'{term}'" for term in terms)
    return f"list_has_any({terms_of(document)}, [{wanted}])"
