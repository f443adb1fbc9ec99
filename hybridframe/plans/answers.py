"""From ingested files to the prompt for an answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from hybridframe.functions.vectors import similarity
from hybridframe.operators.embed import embed
from hybridframe.operators.hybrid import hybrid_search
from hybridframe.operators.nearest import QUERY_ID, nearest_batch
from hybridframe.schema import METADATA
from hybridframe.sources.markdown import MAX_CHARS, chunk_records, chunks, read_markdown, source_of

PREVIEW_CHARS = 200

SYSTEM_PROMPT = "Answer from the context alone. Say so when the context does not hold the answer."
USER_PROMPT = "Context:\n%s\n\nQuestion: %s\n\nAnswer:"


def ingest(collection, path: str, max_chars: int | None = MAX_CHARS) -> None:
    """Replace a collection by the sections of the markdown files under ``path``."""
    files = read_markdown(collection.client.spark, path)
    collection.overwrite(chunk_records(chunks(files, max_chars=max_chars)))


def collection_stats(df: DataFrame) -> DataFrame:
    """One row: all records, and the distinct files they come from."""
    return df.agg(
        F.count(F.lit(1)).alias("total_embeddings"), F.countDistinct(source_of(F.col(METADATA))).alias("unique_source_files")
    )


def retrieve_for(
    df: DataFrame, questions: DataFrame, function: Callable, n_results: int = 5, hybrid: bool = False, metric: str = "cosine", **options
) -> DataFrame:
    """Records for every question (``query_id, text``): ``query_id, rank, _id, distance, document, metadata``.

    Hybrid retrieval takes twice as many candidates from the text and from the vectors and fuses them.
    """
    vectors = embed(questions, function, "text", "vector").select(QUERY_ID, "vector")
    if not hybrid:
        return nearest_batch(df, vectors, n_results, metric, **options)
    candidates = 2 * n_results
    return hybrid_search(
        df,
        {"query_texts": questions, "n_results": candidates},
        {"query_embeddings": vectors, "n_results": candidates},
        {"rrf": {}},
        n_results,
        metric=metric,
        **options,
    )


def display(hits: DataFrame) -> DataFrame:
    """What a reader is shown of every hit."""
    source = source_of(F.col(METADATA))
    return hits.select(
        QUERY_ID,
        "rank",
        "distance",
        similarity(F.col("distance")).alias("similarity"),
        file_name(source).alias("file_name"),
        preview(F.col("document")).alias("preview"),
    )


def preview(text: Column, chars: int = PREVIEW_CHARS) -> Column:
    return F.when(F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit("..."))).otherwise(text)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def contexts(hits: DataFrame) -> DataFrame:
    """``query_id, context``: the few texts found for a question, best first, a blank line between."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "document")))
    texts = F.transform(ordered, lambda hit: hit["document"])
    return hits.groupBy(QUERY_ID).agg(F.array_join(texts, "\n\n").alias("context"))


def prompts(context: DataFrame, questions: DataFrame, user: str = USER_PROMPT, system: str = SYSTEM_PROMPT) -> DataFrame:
    """``query_id, system, prompt``, ready for any model."""
    return context.join(questions, QUERY_ID).select(
        QUERY_ID, F.lit(system).alias("system"), F.format_string(user, "context", "text").alias("prompt")
    )
