"""Hybrid search: a text leg and a vector leg, each with its own filter, fused by reciprocal rank."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from hybridframe.functions.columns import steady
from hybridframe.functions.predicates import only_contains
from hybridframe.functions.vectors import metric_or_default
from hybridframe.operators.approximate import CellIndex, nearest_in_cells
from hybridframe.operators.fulltext import TextIndex, search_index, search_index_batch, search_text, search_text_batch
from hybridframe.operators.joins import top_per_group
from hybridframe.operators.nearest import DEFAULT_K, QUERY_ID, attach, nearest, nearest_ids, query_frame
from hybridframe.operators.retrieve import select_records
from hybridframe.schema import ID

# Fusion defaults.
RANK_WINDOW = 60
RANK_CONSTANT = 60

HITS = f"{QUERY_ID} int, {ID} string, score double, text_rank int, knn_rank int, distance double, rank int"


def reciprocal_rank(legs: Mapping[str, DataFrame], k: int, window: int = RANK_WINDOW, constant: int = RANK_CONSTANT) -> DataFrame:
    """Fuse ranked lists (``query_id, _id, rank``): a document scores the sum of 1 / (constant + rank).

    Every leg gives at most ``window`` rows per query, so what is fused stays small. A ``distance``
    that a leg brings is kept.
    """
    names = list(legs)
    none = F.lit(None)
    labelled = [
        leg.filter(F.col("rank") <= window).select(
            QUERY_ID,
            ID,
            (F.lit(1.0) / (F.lit(constant) + F.col("rank"))).alias("share"),
            *[(F.col("rank") if other == name else none).cast("int").alias(f"{other}_rank") for other in names],
            (F.col("distance") if "distance" in leg.columns else none).cast("double").alias("distance"),
        )
        for name, leg in legs.items()
    ]
    kept = [F.max(name).alias(name) for name in (*[f"{name}_rank" for name in names], "distance")]
    fused = reduce(DataFrame.unionByName, labelled).groupBy(QUERY_ID, ID).agg(steady(F.sum("share")).alias("score"), *kept)
    return top_per_group(fused, QUERY_ID, [F.col("score").desc(), F.col(ID)], k)


def text_leg(df: DataFrame, query: Mapping, window: int, index: TextIndex | None = None, **options) -> DataFrame | None:
    """Ranked ids for ``query``: scored text, or a bare metadata filter in id order with score 1.

    ``query_texts`` may be a DataFrame ``query_id, text`` with one text per query. With an index of
    the same records, a filter of ``$contains`` alone is answered without reading the texts.
    """
    limit = query.get("n_results") or window
    if query.get("query_texts") is not None:
        if index is not None:
            passing = select_records(df, None, query["where"], **options) if query.get("where") else None
            return search_index_batch(index, query["query_texts"], limit, passing)
        return search_text_batch(df, query["query_texts"], limit, query.get("where"), (), **options)
    if query.get("where_document"):
        if index is not None and only_contains(query["where_document"]) and options.get("mode", "terms") == "terms":
            passing = select_records(df, None, query["where"], **options) if query.get("where") else None
            return search_index(index, query["where_document"], limit, passing)
        return search_text(df, query["where_document"], limit, query.get("where"), (), **options)
    if query.get("where"):
        chosen = select_records(df, None, query["where"], **options).select(ID).orderBy(ID).limit(limit)
        scored = chosen.withColumn("score", F.lit(1.0)).withColumn(QUERY_ID, F.lit(0))
        return top_per_group(scored, QUERY_ID, [F.col(ID)], limit)
    return None


def as_vectors(vectors) -> list[list[float]]:
    """One vector or a list of them, as a list of vectors."""
    vectors = list(vectors)
    one = bool(vectors) and not hasattr(vectors[0], "__len__")
    return [[float(x) for x in vector] for vector in ([vectors] if one else vectors)]


def knn_vectors(knn: Mapping, embed: Callable[[list[str]], list] | None) -> list[list[float]] | DataFrame:
    """Query vectors of a vector leg. Vectors win over texts; texts need a function."""
    vectors = knn.get("query_embeddings")
    if isinstance(vectors, DataFrame):
        return vectors
    if vectors is not None and len(vectors):
        return as_vectors(vectors)
    texts = knn.get("query_texts")
    if not texts:
        raise ValueError("knn needs query_embeddings or query_texts")
    if embed is None:
        raise ValueError("knn.query_texts needs an embedding function")
    try:
        return as_vectors(embed([texts] if isinstance(texts, str) else list(texts)))
    except Exception as problem:
        raise ValueError(f"cannot embed knn.query_texts: {problem}") from problem


def vector_leg(df: DataFrame, vectors, knn: Mapping, metric: str, cells: CellIndex | None = None, **options) -> DataFrame:
    """Ranked ids and distances for one vector, several, or a DataFrame ``query_id, vector``."""
    k, where = int(knn.get("n_results", DEFAULT_K)), knn.get("where")
    if cells is not None:
        queries = vectors if isinstance(vectors, DataFrame) else query_frame(df.sparkSession, vectors)
        return nearest_in_cells(cells.records, cells.centroids, queries, cells.probes, k, metric, where, (), **options)
    if not isinstance(vectors, DataFrame):
        if len(vectors) == 1:
            return nearest(df, vectors[0], k, metric, where, include=(), **options)
        vectors = query_frame(df.sparkSession, vectors)
    return nearest_ids(select_records(df, None, where, **options), vectors, k, metric)


def _per_query(text: DataFrame, queries: DataFrame) -> DataFrame:
    """The one short list of text hits, repeated for every query."""
    hits = text.agg(F.collect_list(F.struct(ID, "score", "rank")).alias("hits"))
    return queries.select(QUERY_ID, F.explode(hits.scalar()).alias("hit")).select(QUERY_ID, "hit.*")


def _rrf_options(rank: Mapping | None) -> tuple[int, int]:
    if rank is not None and set(rank) - {"rrf"}:
        raise ValueError(f"unknown ranking {sorted(set(rank) - {'rrf'})}")
    options = (rank or {}).get("rrf") or {}
    return int(options.get("rank_window_size", RANK_WINDOW)), int(options.get("rank_constant", RANK_CONSTANT))


def hybrid_search(
    df: DataFrame,
    query: Mapping | None = None,
    knn: Mapping | None = None,
    rank: Mapping | None = None,
    n_results: int = DEFAULT_K,
    include=None,
    metric: str | None = "cosine",
    embed: Callable[[list[str]], list] | None = None,
    index: TextIndex | None = None,
    cells: CellIndex | None = None,
    **options,
) -> DataFrame:
    """Best records over both legs: ``query_id, rank, _id, score, text_rank, knn_rank, distance``.

    One leg alone keeps its own order. With several query vectors the text leg is fused with each.
    Neither leg gives no rows. ``index`` and ``cells`` are indexes of the same records, if there are
    any; with ``cells`` the vector leg is approximate.
    """
    window, constant = _rrf_options(rank)
    n_results = n_results or window
    metric = metric_or_default(metric)
    text, near, vectors, n_queries = None, None, None, 1
    if knn:
        vectors = knn_vectors(knn, embed)
        n_queries = vectors.count() if isinstance(vectors, DataFrame) else len(vectors)
        near = vector_leg(df, vectors, knn, metric, cells, **options)
    if query:
        text = text_leg(df, query, window if knn else n_results, index, **options)
        if query.get("query_texts") is not None:
            n_queries = max(n_queries, query["query_texts"].count())
        elif text is not None and (n_queries > 1 or isinstance(vectors, DataFrame)):
            text = _per_query(text, near_queries(df, vectors))
    if text is not None and near is not None:
        hits = reciprocal_rank({"text": text, "knn": near}, n_results, window, constant)
    elif text is not None:
        hits = text.filter(F.col("rank") <= n_results).withColumn("text_rank", F.col("rank"))
    elif near is not None:
        hits = near.filter(F.col("rank") <= n_results).withColumn("knn_rank", F.col("rank"))
    else:
        hits = df.sparkSession.createDataFrame([], HITS)
    return attach(_shaped(hits), df, include, bound=n_results * n_queries)


def near_queries(df: DataFrame, vectors) -> DataFrame:
    queries = vectors if isinstance(vectors, DataFrame) else query_frame(df.sparkSession, vectors)
    return queries.select(QUERY_ID)


def _shaped(hits: DataFrame) -> DataFrame:
    columns = {"score": "double", "text_rank": "int", "knn_rank": "int", "distance": "double"}
    for name, kind in columns.items():
        if name not in hits.columns:
            hits = hits.withColumn(name, F.lit(None).cast(kind))
    return hits.select(QUERY_ID, "rank", ID, *columns)
