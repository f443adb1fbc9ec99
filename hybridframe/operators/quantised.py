"""Approximate search in short codes (product quantisation), with an exact ranking of what they propose.

A vector is cut into sub-spaces, and each part is replaced by the number of its closest centre, one byte. Distances between a query and a code
are sums of one table entry per part. A search reads codes only, keeps the best ``again`` per query, and measures these on the vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hybridframe.functions.vectors import closest_first, metric_or_default
from hybridframe.operators.approximate import unit_rows
from hybridframe.operators.joins import join_small, top_per_group
from hybridframe.operators.nearest import DEFAULT_K, PRODUCTS, QUERY_ID, ROWS, NearestLists, QueryBlock, attach, query_shape, with_vectors
from hybridframe.operators.tiles import Compare, Tiled, nearest_in_tiles
from hybridframe.schema import EMBEDDING, ID

# Codebooks are learnt from at most this many records, drawn by a hash of their ids; every record gets a code.
SAMPLE, ROUNDS = 1 << 14, 15


class Codebooks(NamedTuple):
    """``centres[part]`` is a matrix of at most 256 rows; ``edges`` are where the parts begin and end."""

    centres: list[np.ndarray]
    edges: list[int]


def _closest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    found = [
        ((centres**2).sum(axis=1)[None, :] - 2 * part @ centres.T).argmin(axis=1)
        for part in np.array_split(x, max(1, len(x) * len(centres) // PRODUCTS))
    ]
    return np.concatenate(found)


def train_codebooks(df: DataFrame, dimension: int, parts: int, metric: str = "cosine", centres: int = 256, seed: int = 7) -> Codebooks:
    """Centres of every sub-space, by Lloyd's rounds on a bounded sample."""
    drawn = with_vectors(df, dimension).select(ID, EMBEDDING).orderBy(F.xxhash64(F.lit(seed), ID), ID).limit(SAMPLE).collect()
    x = unit_rows(np.array([row[EMBEDDING] for row in drawn], dtype=np.float64).reshape(-1, dimension), metric)
    x = x[np.isfinite(x).all(axis=1)]
    edges, random, books = np.linspace(0, dimension, parts + 1).astype(int).tolist(), np.random.default_rng(seed), []
    for a, b in zip(edges, edges[1:]):
        own = np.unique(x[:, a:b], axis=0)
        book = own[random.permutation(len(own))[:centres]] if len(own) else np.zeros((1, b - a))
        for _ in range(ROUNDS if len(own) > centres else 0):
            nearest = _closest(own, book)
            sums = np.zeros_like(book)
            np.add.at(sums, nearest, own)
            counts = np.bincount(nearest, minlength=len(book))
            book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
        books.append(book)
    return Codebooks(books, edges)


def with_codes(df: DataFrame, books: Codebooks, dimension: int, metric: str = "cosine") -> DataFrame:
    """Records with ``codes``, a byte for each part. Vectors without a length or a number are left out."""
    shared = df.sparkSession.sparkContext.broadcast(books)

    def encode(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for vectors in columns:
            x = unit_rows(np.stack(vectors.to_numpy()).astype(np.float64), metric) if len(vectors) else np.zeros((0, dimension))
            codes = np.stack([_closest(x[:, a:b], book) for a, b, book in zip(own.edges, own.edges[1:], own.centres)], axis=1).astype(np.uint8)
            usable = np.isfinite(x).all(axis=1)
            yield pd.Series([code.tobytes() if good else None for code, good in zip(codes, usable)], dtype=object)

    coded = F.pandas_udf(encode, "binary").asNondeterministic()
    return with_vectors(df, dimension).withColumn("codes", coded(F.col(EMBEDDING))).filter("codes is not null")


class CodeLists(NearestLists):
    """Lists by sums of table entries; lower is closer for every metric.

    A sum is the squared distance of a query to what the code stands for (less its inner product), so vectors put together from
    the centres tell by a product which sums may be among the first.
    """

    def __init__(self, metric: str, block: QueryBlock, k: int, tables: list[np.ndarray]):
        super().__init__("inner_product" if metric == "inner_product" else "l2", block, k)
        self.tables = tables

    def square(self, limits: np.ndarray) -> np.ndarray:
        return limits

    def measure(self, rows: np.ndarray, queries: np.ndarray, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        cost = np.zeros(len(rows))
        for part, table in enumerate(self.tables):
            cost += table[queries, self.codes[rows, part]]
        return cost


class CompareCodes(Compare):
    """Sums of table entries instead of distances. A code is much shorter than a vector, so a tile holds more of them."""

    column, records = "codes", 4

    def __init__(self, metric: str, k: int, dimension: int, books: Codebooks):
        super().__init__("l2", k, dimension)
        self.wanted, self.books = metric, books

    def prepare(self, ids: list, vectors: np.ndarray) -> NearestLists:
        x, edges = unit_rows(vectors, self.wanted), self.books.edges
        parts = [x[:, a:b] for a, b in zip(edges, edges[1:])]
        if self.wanted == "inner_product":
            tables = [-(part @ book.T) for part, book in zip(parts, self.books.centres)]
        else:
            squares = [((part[start : start + ROWS, None, :] - book[None]) ** 2).sum(axis=2) for part, book in zip(parts, self.books.centres) for start in range(0, max(1, len(part)), ROWS)]
            step = -(-max(1, len(x)) // ROWS)
            tables = [np.concatenate(squares[at : at + step]) for at in range(0, len(squares), step)]
        return CodeLists(self.wanted, QueryBlock(ids, x), self.k, tables)

    def values(self, records: pa.Array) -> np.ndarray:
        return self._codes(records).astype(np.float64)

    def _codes(self, records: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(records.to_pylist()), np.uint8).reshape(len(records), -1)

    def tile(self, ids: pa.Array, records: pa.Array, lists: NearestLists) -> None:
        lists.codes = self._codes(records)
        x = np.concatenate([book[lists.codes[:, part]] for part, book in enumerate(self.books.centres)], axis=1)
        lists.compare(ids, x)


def propose(coded: DataFrame, books: Codebooks, queries: DataFrame, again: int, metric: str, dimension: int) -> Tiled:
    """The ``again`` closest codes of every query. ``coded`` needs ``_id, codes`` and, to look at a part of them, ``cell``."""
    records = coded if "cell" in coded.columns else coded.withColumn("cell", F.lit(0).cast("long"))
    asked = queries if "cell" in queries.columns else queries.withColumn("cell", F.lit(0).cast("long"))
    return nearest_in_tiles(records, asked.filter("vector is not null"), CompareCodes(metric, again, dimension, books))


def measured(pairs: DataFrame, records: DataFrame, queries: DataFrame, metric: str) -> DataFrame:
    """``query_id, _id, distance`` of given pairs, from the vectors."""
    rows = pairs.select(QUERY_ID, ID).join(records.select(ID, EMBEDDING), ID).join(queries.select(QUERY_ID, "vector"), QUERY_ID)

    @F.pandas_udf("double")
    def distances(own: pd.Series, asked: pd.Series) -> pd.Series:
        x, y = (np.stack(v.to_numpy()).astype(np.float64) if len(v) else np.zeros((0, 1)) for v in (own, asked))
        lengths = np.sqrt((x**2).sum(axis=1))
        if metric == "l2":
            return pd.Series(np.sqrt(((x - y) ** 2).sum(axis=1)))
        dots = (x * y).sum(axis=1)
        if metric == "inner_product":
            return pd.Series(dots)
        with np.errstate(divide="ignore", invalid="ignore"):
            return pd.Series(np.maximum(1.0 - dots / (lengths * np.sqrt((y**2).sum(axis=1))), 0.0))

    return rows.select(QUERY_ID, ID, distances(EMBEDDING, "vector").alias("distance")).filter("distance is not null and not isnan(distance)")


def nearest_in_codes(
    coded: DataFrame, records: DataFrame, books: Codebooks, queries: DataFrame, k: int = DEFAULT_K, again: int = 100, metric: str | None = "cosine", include: Iterable[str] = ()
) -> DataFrame:
    """The k closest of the ``again`` records whose codes are closest, by their real distances."""
    metric = metric_or_default(metric)
    total, dimension = query_shape(queries)
    proposed = propose(coded, books, queries, again, metric, dimension).ranked(again, "l2")
    exact = measured(proposed, records, queries, metric)
    return attach(top_per_group(exact, QUERY_ID, [closest_first(metric), F.col(ID)], k), records, include, bound=k * total)
