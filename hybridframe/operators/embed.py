"""Text to vector.

An embedding function is any callable from a list of texts to a list of vectors, with an optional
``dimension``. ``HashingEmbedder`` needs no model: Spark cuts and hashes the terms, and a worker
only adds them up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from hybridframe.functions.text import distinct_terms, split_terms, tokens
from hybridframe.schema import DEFAULT_DIMENSION, DOCUMENT, EMBEDDING

BATCH_SIZE = 32

# Fixed value: the seed of Spark's xxhash64.
SPARK_SEED = 42


class HashingEmbedder:
    """Signed feature hashing of the terms of a text, brought to length 1.

    A term's hash chooses its component and its sign. The hash is Spark's ``xxhash64``; a
    ``portable`` embedder takes digits of the MD5 instead (eight for the component, the ninth for
    the sign), slower, but any SQL engine can compute the same vector.
    """

    def __init__(self, dimension: int = DEFAULT_DIMENSION, portable: bool = False):
        if dimension <= 0:
            raise ValueError("dimension must be positive")
        self.dimension = dimension
        self.portable = portable

    def __call__(self, texts: str | list[str]) -> list[list[float]]:
        texts = [texts] if isinstance(texts, str) else list(texts)
        codes = pd.Series([[self._code(term) for term in split_terms(text)] for text in texts], dtype=object)
        return [[float(x) for x in vector] for vector in _add_up(codes, self.dimension)]

    def _code(self, term: str) -> int:
        if not self.portable:
            import xxhash

            signed = xxhash.xxh64_intdigest(term.encode(), seed=SPARK_SEED)
            return (signed - 2**64 if signed >= 2**63 else signed) % (2 * self.dimension)
        digits = hashlib.md5(term.encode()).hexdigest()
        return int(digits[:8], 16) % self.dimension * 2 + int(digits[8], 16) % 2

    def codes(self, text: Column) -> Column:
        """``array<int>``: two times the component of every term, plus one for a negative sign."""
        def portable(digits: Column) -> Column:
            slot = F.conv(F.substring(digits, 1, 8), 16, 10).cast("long") % self.dimension
            return (slot * 2 + F.conv(F.substring(digits, 9, 1), 16, 10).cast("long") % 2).cast("int")

        if self.portable:
            return F.transform(F.transform(tokens(text), F.md5), portable)
        return F.transform(tokens(text), lambda term: F.pmod(F.xxhash64(term), F.lit(2 * self.dimension)).cast("int"))

    def column(self, text: Column) -> Column:
        dimension = self.dimension

        @F.pandas_udf("array<float>")
        def add_up(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for codes in batches:
                yield pd.Series(_add_up(codes, dimension), index=codes.index, dtype=object)

        return add_up.asNondeterministic()(self.codes(text))


def _unit_rows(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x**2).sum(axis=1))
    return x / np.where(length == 0.0, 1.0, length)[:, None]


def _add_up(codes: pd.Series, dimension: int) -> list:
    """Dense float32 unit vectors for arrays of term codes; None for a null text."""
    vectors: list = [None] * len(codes)
    known = np.flatnonzero(codes.notna().to_numpy())
    # 2,048 rows of 384 doubles at a time.
    for start in range(0, len(known), 2048):
        rows = known[start : start + 2048]
        parts = [np.asarray(codes.iloc[r], dtype=np.int64) for r in rows]
        flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
        total = np.bincount(owner * dimension + flat // 2, 1.0 - 2.0 * (flat % 2), len(rows) * dimension)
        for row, vector in zip(rows, _unit_rows(total.reshape(len(rows), dimension)).astype(np.float32)):
            vectors[row] = vector
    return vectors


def dimension_of(function: Callable) -> int:
    """The function's ``dimension``, else the size of what it returns for a word."""
    declared = getattr(function, "dimension", None)
    if declared is not None:
        return int(declared)
    try:
        return len(function(["dimension"])[0])
    except Exception as problem:
        raise ValueError(f"cannot tell the dimension of the embedding function: {problem}") from problem


def embedding(text: Column, function: Callable, batch_size: int = BATCH_SIZE) -> Column:
    """Vector column for a text column. The function is unpickled once per worker, not per batch."""
    if isinstance(function, HashingEmbedder):
        return function.column(text)

    @F.pandas_udf("array<float>")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            vectors: list = [None] * len(texts)
            known = np.flatnonzero(texts.notna().to_numpy())
            for start in range(0, len(known), batch_size):
                rows = known[start : start + batch_size]
                answer = function([str(texts.iloc[r]) for r in rows])
                if len(answer) != len(rows):
                    raise ValueError(f"{len(rows)} texts gave {len(answer)} vectors")
                for row, vector in zip(rows, answer):
                    vectors[row] = np.asarray(vector, dtype=np.float32)
            yield pd.Series(vectors, index=texts.index, dtype=object)

    return apply.asNondeterministic()(text)


def embed(df: DataFrame, function: Callable, text: str = DOCUMENT, into: str = EMBEDDING, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Add vectors for the texts of a frame; a null text gives a null vector."""
    return df.withColumn(into, embedding(F.col(text), function, batch_size))


def embed_missing(df: DataFrame, function: Callable, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Embed the documents of records that bring no vector; given vectors are kept."""
    needed = F.when(F.col(EMBEDDING).isNull(), F.col(DOCUMENT))
    made = df.withColumn("_made", embedding(needed, function, batch_size))
    return made.withColumn(EMBEDDING, F.coalesce(EMBEDDING, "_made")).drop("_made")


def wrong_size(df: DataFrame, dimension: int, vector: str = EMBEDDING) -> DataFrame:
    """Rows whose vector has not the expected size."""
    return df.filter(F.col(vector).isNotNull() & (F.size(vector) != dimension))
