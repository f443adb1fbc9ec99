"""Exact nearest neighbours for one query or many.

One short query is a generated expression and a top-k that never shuffles the records. A long one, or up to
``QUERY_BLOCK`` of them (their number is checked), are a matrix that every task holds; a task multiplies each Arrow batch of
records by it and keeps the best k per query, so only ``partitions * queries * k`` rows are shuffled. More queries stay a
DataFrame: ``operators/tiles.py`` lays records and queries out as a grid of tiles.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hybridframe.functions.columns import steady
from hybridframe.functions.vectors import UNROLL, closest_first, distance, metric_or_default
from hybridframe.operators.joins import join_small, top_per_group
from hybridframe.operators.retrieve import project, select_records
from hybridframe.schema import EMBEDDING, ID

QUERY_ID = "query_id"
DEFAULT_K = 10
# Queries per matrix: 2,048 of 384 components are 6 MB in every task.
QUERY_BLOCK = 2048
# Products of a record and a query that a task holds at a time, records that are compared at a time, and pairs that are measured at a time.
PRODUCTS, ROWS, PAIRS = 1 << 21, 1 << 10, 1 << 14
# Vectors of other lengths are compared in double precision only; any product in single precision is above the last.
LEAST_LENGTH, MOST_LENGTH, LOWEST = 1e-12, 1e12, -3e38


def with_vectors(df: DataFrame, dimension: int) -> DataFrame:
    """Records that can be searched: their vector is there and has the right size."""
    return df.filter(F.size(EMBEDDING) == dimension)


def nearest(
    df: DataFrame,
    query: list[float],
    k: int = DEFAULT_K,
    metric: str | None = "cosine",
    where=None,
    where_document=None,
    include=None,
    **options,
) -> DataFrame:
    """The k records closest to one vector: ``_id, distance, rank`` and the included columns.

    Filters come first, so k results are found whenever k records pass them.
    """
    candidates = select_records(df, None, where, where_document, **options)
    query = [float(x) for x in query]
    if len(query) > UNROLL:
        hits = nearest_to_block(candidates, QueryBlock([0], [query]), T.IntegerType(), k, metric)
        return attach(hits, df, include, bound=k)
    measured = with_vectors(candidates, len(query)).withColumn("distance", distance(metric, EMBEDDING, query))
    best = project(measured, include, ("distance",)).orderBy(closest_first(metric), ID).limit(k)
    # Dropping the distances that are NULL before the top k would measure every record twice.
    best = best.filter("distance is not null")
    return top_per_group(best.withColumn(QUERY_ID, F.lit(0)), QUERY_ID, [closest_first(metric), F.col(ID)], k)


def query_frame(spark: SparkSession, vectors: list[list[float]]) -> DataFrame:
    """Queries given in Python, numbered from 0."""
    return spark.createDataFrame(list(enumerate(vectors)), f"{QUERY_ID} int, vector array<double>")


class QueryBlock:
    """Some queries as a matrix."""

    def __init__(self, ids: list, vectors):
        self.ids = ids
        self.matrix = np.asarray(vectors, dtype=np.float64)
        self.norms = np.sqrt((self.matrix**2).sum(axis=1))


def query_shape(queries: DataFrame) -> tuple[int, int]:
    """How many queries there are, and their dimension."""
    total, low, high = queries.filter("vector is not null").agg(F.count(F.lit(1)), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if low != high:
        raise ValueError(f"query vectors of {low} to {high} components")
    return total, low or 0


def _measure(metric: str, x: np.ndarray, own: np.ndarray, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Distances of some rows, of lengths ``own``, to a query each (or one query)."""
    if metric == "l2":
        return np.sqrt(((x - queries) ** 2).sum(axis=1))
    dots = (x * queries).sum(axis=1)
    if metric == "inner_product":
        return dots
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.maximum(1.0 - dots / (own * norms), 0.0)


def _rough(metric: str, x: np.ndarray, own: np.ndarray, block: QueryBlock) -> tuple[np.ndarray, np.ndarray]:
    """Cost of every (row, query) from one matrix product, and a bound on its rounding error."""
    dots = x @ block.matrix.T
    scale = 2e-9 * (own[:, None] + block.norms[None, :] + 1.0) ** 2
    if metric == "l2":
        return own[:, None] ** 2 + block.norms[None, :] ** 2 - 2.0 * dots, scale
    if metric == "inner_product":
        return -dots, scale
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1.0 - dots / (own[:, None] * block.norms[None, :]), np.full_like(dots, 2e-9)


class TopLists:
    """The k first records so far of every query of a block, by an order in which less is better."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.found: dict[int, tuple] = {}
        # No record that lies above this can still enter a query's list.
        self.limits = np.full(queries, np.inf)

    def offer(self, q: int, names: np.ndarray, order: np.ndarray) -> None:
        if q in self.found:
            names = np.concatenate([self.found[q][0], names])
            order = np.concatenate([self.found[q][1], order])
        key = steady(order)
        if len(key) > 4 * self.k:
            near = np.flatnonzero(key <= np.partition(key, self.k - 1)[self.k - 1])
            names, order, key = names[near], order[near], key[near]
        keep = np.lexsort((names, key))[: self.k]
        self.found[q] = names[keep], order[keep]
        if len(keep) == self.k:
            self.limits[q] = order[keep].max()

    def batches(self, ids: list, id_type: pa.DataType, columns: list[str], sign: float = 1.0):
        """``query_id, _id, value`` as Arrow batches, one per query."""
        for q, (names, order) in self.found.items():
            arrays = [pa.array([ids[q]] * len(names), id_type), pa.array(names, pa.string()), pa.array(order * sign)]
            yield pa.record_batch(arrays, names=columns)


class NearestLists:
    """The closest records of Arrow batches ``_id, embedding[, keys]``.

    A product in single precision, with a bound on its rounding error, tells which pairs may be among the k first of a query; these
    are measured in double precision and collected, and the k first are taken when as many records again as before have been seen.
    """

    def __init__(self, metric: str, block: QueryBlock, k: int):
        queries, dimension = block.matrix.shape if len(block.ids) else (0, 0)
        self.metric, self.block, self.k = metric, block, k
        # No record that lies above this can still enter a query's list.
        self.limits = np.full(queries, np.inf)
        self.held = np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0)
        self.pending: list[tuple] = []
        self.waiting, self.seen, self.settled = 0, 0, 0
        # (dimension + 2 terms and their own rounding) * 2 ** -24, and as much again
        self.slack = (dimension + 16) * 2.0**-23
        norms = block.norms
        self.plain = bool(((norms > 0) & ~((norms > LEAST_LENGTH) & (norms < MOST_LENGTH))).any())
        if not self.plain and queries:
            with np.errstate(divide="ignore", invalid="ignore"):
                own = block.matrix / norms[:, None] if metric == "cosine" else block.matrix
            more = {"cosine": [], "inner_product": [self.slack * norms], "l2": [np.full(queries, -0.5 * (1 - self.slack)), self.slack * norms]}
            self.single = np.column_stack([own, *more[metric]]).astype(np.float32)

    def add(self, batch: pa.RecordBatch) -> None:
        """Take in a batch, some rows at a time."""
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            self.compare(part.column(0), matrix_of(part.column(1), self.block.matrix.shape[1]))

    def measure(self, rows: np.ndarray, queries: np.ndarray, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """What pairs are ordered by; less is closer."""
        exact = _measure(self.metric, x[rows], own[rows], self.block.matrix[queries], self.block.norms[queries])
        return -exact if self.metric == "inner_product" else exact

    def square(self, limits: np.ndarray) -> np.ndarray:
        """The limits of squared distances."""
        return limits**2

    def compare(self, ids: pa.Array, x: np.ndarray, admitted: Callable[[slice], np.ndarray] | None = None) -> None:
        """Offer some rows (no more than ``ROWS``) to all queries. ``admitted``, if given, says of a part of the queries which of the
        pairs (queries x rows) may be taken; it is called once for each part.
        """
        own, names = np.sqrt((x**2).sum(axis=1)), ids.to_numpy(zero_copy_only=False)
        single = (own > LEAST_LENGTH) & (own < MOST_LENGTH) | ((own == 0) & (self.metric != "cosine"))
        product = None if self.plain else self._product(x, own, single)
        step = max(1, PRODUCTS // max(1, len(x)))
        # a length that is no number, or none for a cosine, is never compared
        odd = np.flatnonzero(~single & (own > 0))
        for start in range(0, len(self.block.ids), step):
            part = slice(start, start + step)
            mask = None if admitted is None else admitted(part)
            if product is None:
                self._offer_plain(np.flatnonzero(own >= 0), part, mask, names, x, own)
                continue
            score = self.single[part] @ product
            if mask is not None:
                score[~mask] = -np.inf
            floor = self._floor(part)
            fresh = np.flatnonzero(np.isneginf(floor))
            if len(fresh) and single.sum() > self.k:
                # the k-th best score of these rows, less twice the bound
                longest, first = own[single].max(), np.nan_to_num(score[fresh], nan=-np.inf)
                apart = {"cosine": np.ones(len(fresh)), "inner_product": self.block.norms[part][fresh] * longest}
                apart["l2"] = self.block.norms[part][fresh] * longest + longest**2
                floor[fresh] = np.partition(first, -self.k, axis=1)[:, -self.k] - 4 * self.slack * apart[self.metric]
            q, rows = np.divmod(np.flatnonzero(score >= np.maximum(floor, LOWEST).astype(np.float32)[:, None]), len(x))
            self._take(q + start, rows, names, x, own)
            if len(odd):
                self._offer_plain(odd, part, mask, names, x, own)
        self.seen += len(x)
        if self.seen >= 1.5 * self.settled:
            self.settle()

    def _product(self, x: np.ndarray, own: np.ndarray, single: np.ndarray) -> np.ndarray:
        """The rows in single precision, as columns; with what adds the error's bound to a product. Others are no numbers."""
        with np.errstate(all="ignore"):
            rows = x / own[:, None] if self.metric == "cosine" else x
            more = {"cosine": [], "inner_product": [own], "l2": [own**2, own]}[self.metric]
            made = np.column_stack([rows, *more]).astype(np.float32)
        made[~single] = np.nan
        return np.ascontiguousarray(made.T)

    def _floor(self, part: slice) -> np.ndarray:
        """Pairs of a smaller product are above the limits of these queries for certain; equal records must tie, hence the billionth."""
        limits, norms = self.limits[part], self.block.norms[part]
        if self.metric == "cosine":
            return 1 - limits * (1 + 1e-9) - self.slack
        if self.metric == "inner_product":
            return -limits - np.where(np.isinf(limits), 0, np.abs(limits)) * (self.slack + 1e-9)
        squares = self.square(limits) * (1 + 1e-9)
        return (norms**2 - squares) / 2 - self.slack * norms**2 - np.where(np.isinf(squares), 0, squares) * self.slack

    def _offer_plain(self, rows: np.ndarray, part: slice, mask: np.ndarray | None, names: np.ndarray, x: np.ndarray, own: np.ndarray) -> None:
        """The same in double precision, for lengths that single precision can't hold."""
        block = QueryBlock(self.block.ids[part], self.block.matrix[part])
        with np.errstate(all="ignore"):
            cost, slack = _rough(self.metric, x[rows], own[rows], block)
            limits = self.square(self.limits[part]) if self.metric == "l2" else self.limits[part]
            possible = cost - slack <= limits
        if mask is not None:
            possible &= mask[:, rows].T
        at, q = np.nonzero(possible)
        with np.errstate(all="ignore"):
            self._take(q + part.start, rows[at], names, x, own)

    def _take(self, queries: np.ndarray, rows: np.ndarray, names: np.ndarray, x: np.ndarray, own: np.ndarray) -> None:
        for start in range(0, len(rows), PAIRS):
            q, r = queries[start : start + PAIRS], rows[start : start + PAIRS]
            order = self.measure(r, q, x, own)
            limits = self.limits[q]
            near = np.flatnonzero(order <= np.where(np.isinf(limits), limits, limits + np.abs(limits) * 1e-9))
            self.pending.append((q[near], names[r[near]], order[near]))
            self.waiting += len(near)
        if self.waiting > max(4 * self.k * len(self.limits), 1 << 20):
            self.settle()

    def settle(self) -> None:
        """Keep the k first of every query, by the steady order and the id."""
        q, names, order = (np.concatenate(parts) for parts in zip(self.held, *self.pending))
        self.pending, self.waiting, self.settled = [], 0, self.seen
        key = steady(order)
        at = np.lexsort((key, q))
        same = np.zeros(len(at) + 1, bool)
        same[1:-1] = (q[at[1:]] == q[at[:-1]]) & (key[at[1:]] == key[at[:-1]])
        tied = at[same[1:] | same[:-1]]
        if len(tied):
            place = np.zeros(len(at), np.int64)
            place[tied] = np.unique(names[tied], return_inverse=True)[1]
            at = np.lexsort((place, key, q))
        counts = np.bincount(q, minlength=len(self.limits))
        starts = np.cumsum(counts) - counts
        nth = np.arange(len(at)) - starts[q[at]]
        keep = at[nth < self.k]
        self.held = q[keep], names[keep], order[keep]
        full = np.flatnonzero(counts >= self.k)
        # of equal keys the largest order
        largest = np.maximum.reduceat(self.held[2], np.flatnonzero(nth[nth < self.k] == 0)) if len(keep) else np.zeros(0)
        asked = np.flatnonzero(counts)
        self.limits[full] = largest[np.searchsorted(asked, full)]

    def batches(self, id_type: pa.DataType, columns: list[str], sign: float = 1.0):
        """``query_id, _id, value`` of all queries as Arrow batches."""
        self.settle()
        q, names, order = self.held
        ids = pa.array(self.block.ids, id_type)
        for start in range(0, len(q), PAIRS):
            part = slice(start, start + PAIRS)
            yield pa.record_batch([ids.take(pa.array(q[part])), pa.array(names[part], pa.string()), pa.array(order[part] * sign)], names=columns)


def matrix_of(vectors: pa.Array, dimension: int) -> np.ndarray:
    """An Arrow list column as rows of doubles."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension).astype(np.float64)


def arrow_type(id_type: T.DataType) -> pa.DataType:
    """Arrow type of a query id: a string, an int or a long."""
    return {"string": pa.string(), "int": pa.int32()}.get(id_type.simpleString(), pa.int64())


def _search_block(candidates: DataFrame, block: QueryBlock, metric: str, k: int, id_type: T.DataType) -> DataFrame:
    shared = candidates.sparkSession.sparkContext.broadcast(block)
    schema = T.StructType(
        [T.StructField(QUERY_ID, id_type), T.StructField(ID, T.StringType()), T.StructField("distance", T.DoubleType())]
    )
    arrow_id, sign = arrow_type(id_type), -1.0 if metric == "inner_product" else 1.0

    def search(batches):
        lists = NearestLists(metric, shared.value, k)
        for batch in batches:
            if batch.num_rows:
                lists.add(batch)
        yield from lists.batches(arrow_id, schema.fieldNames(), sign)

    return candidates.mapInArrow(search, schema)


def nearest_ids(candidates: DataFrame, queries: DataFrame, k: int, metric: str | None) -> DataFrame:
    """``query_id, rank, _id, distance`` of the k closest candidates of every query (``query_id, vector``).

    Few queries are read and go to every task; beyond ``QUERY_BLOCK`` they stay where they are, see ``tiles``.
    """
    from hybridframe.operators import tiles

    metric = metric_or_default(metric)
    queries = queries.filter("vector is not null").select(QUERY_ID, "vector")
    total, dimension = query_shape(queries)
    if total > QUERY_BLOCK:
        return tiles.nearest_in_grid(candidates, queries, k, metric, total, dimension)
    rows = queries.limit(QUERY_BLOCK).collect()
    block = QueryBlock([row[QUERY_ID] for row in rows], [row["vector"] for row in rows]) if rows else None
    return nearest_to_block(candidates, block, queries.schema[QUERY_ID].dataType, k, metric)


def nearest_to_block(candidates: DataFrame, block: QueryBlock | None, id_type: T.DataType, k: int, metric: str | None) -> DataFrame:
    """``nearest_ids`` for one block of queries read already."""
    metric, parts = metric_or_default(metric), []
    if block is not None:
        searched = with_vectors(candidates, block.matrix.shape[1]).select(ID, EMBEDDING)
        parts.append(_search_block(searched, block, metric, k, id_type))
    return merged(parts, candidates.sparkSession, id_type, "distance", [closest_first(metric), F.col(ID)], k)


def merged(parts: list[DataFrame], spark: SparkSession, id_type: T.DataType, value: str, order: list[Column], k: int) -> DataFrame:
    """The lists of all tasks and blocks, cut to k per query."""
    if not parts:
        parts = [spark.createDataFrame([], T.StructType([T.StructField(QUERY_ID, id_type)]).add(ID, "string").add(value, "double"))]
    return top_per_group(reduce(DataFrame.unionByName, parts), QUERY_ID, order, k)


def attach(hits: DataFrame, df: DataFrame, include=None, bound: int | None = None) -> DataFrame:
    """Give found ids the record columns asked for. The few hits travel to the records."""
    records = project(df, include)
    if records.columns == [ID]:
        return hits
    return join_small(records, hits, ID, bound=bound)


def nearest_batch(
    df: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    metric: str | None = "cosine",
    where=None,
    where_document=None,
    include=None,
    **options,
) -> DataFrame:
    """The k closest records of every row of ``queries`` (``query_id, vector``), filters first."""
    candidates = select_records(df, None, where, where_document, **options)
    hits = nearest_ids(candidates, queries, k, metric)
    return attach(hits, df, include, bound=k * queries.count())
