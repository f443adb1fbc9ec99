"""Token counts by a table of frequent pre-tokens that all workers hold, and worker caches for the rest."""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridframe.llm import bpe
from hybridframe.llm.common import documents, query, stage

# The table's size, the pre-tokens that a task offers for it, and those that a task counts at a time: all fixed,
# so what is sent to the driver and to the workers is bounded for any corpus. They decide about speed only.
FREQUENT, OFFERED, COUNTED = 1 << 16, 1 << 14, 1 << 19
# Summaries that are merged into one at a time.
MERGED = 64
LONGEST = 64  # bytes of a pre-token in the table
LIMIT = 512


def frequent(df: DataFrame, path: str, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The most frequent pre-tokens of all texts with their numbers of tokens.

    Each task counts what it reads and leaves one summary, a row with its most frequent pre-tokens; when it has met ``COUNTED`` different ones it
    lowers all counts together (the Misra-Gries rule), so a pre-token that makes up more than 1 / ``COUNTED`` of its input
    cannot be lost. ``MERGED`` summaries at a time are merged into one of ``FREQUENT`` pre-tokens, until one is left: no pre-token is shuffled by
    itself, and a merge is as large for any number of tasks.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, counts = bpe.vocabulary(path), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for part in bpe.pieces(text or "", vocab):
                    if not isinstance(part, str):
                        counts.update(part)
                if len(counts) > COUNTED:
                    less = sorted(counts.values(), reverse=True)[COUNTED // 2]
                    counts = Counter({piece: n - less for piece, n in counts.items() if n > less})
        yield from _summary(((piece, n) for piece, n in counts.most_common(OFFERED) if len(piece.encode("utf-8", "surrogatepass")) <= LONGEST)).to_batches()

    def merge(summaries: pa.Table) -> pa.Table:
        counts = Counter()
        for pieces, numbers in zip(summaries.column("pieces"), summaries.column("ns")):
            counts.update(dict(zip(pieces.as_py(), numbers.as_py())))
        # ties by text, so that reruns agree
        return _summary(sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:FREQUENT])

    def lengths(pieces: pd.Series) -> pd.Series:
        vocab = bpe.vocabulary(path)
        return pieces.map(lambda piece: len(vocab.encode_piece(piece.encode()))).astype("int16")

    schema = "pieces array<string>, ns array<long>"
    summaries = stage(df.select(F.col(text_col).alias("text")).mapInArrow(count, schema))
    left = summaries.count()
    while left > 1:
        numbered = summaries.withColumn("row", F.monotonically_increasing_id())
        merged = numbered.groupBy(F.pmod(F.xxhash64("row"), F.lit(-(-left // MERGED)))).applyInArrow(lambda rows: merge(rows), schema)
        summaries = stage(merged)
        left = summaries.count()
    top = summaries.select(F.explode(F.arrays_zip("pieces", "ns")).alias("one")).select(F.col("one.pieces").alias("piece"))
    table = top.select("piece", F.pandas_udf(lengths, "short")("piece").alias("tokens")).toPandas()
    return table["piece"].to_numpy(), table["tokens"].to_numpy(np.int16)


def _summary(counts: Iterable[tuple[str, int]]) -> pa.Table:
    counts = list(counts)
    arrays = [pa.array([[piece for piece, _ in counts]], pa.list_(pa.string())), pa.array([[n for _, n in counts]], pa.list_(pa.int64()))]
    return pa.Table.from_arrays(arrays, ["pieces", "ns"])


class Lengths(dict):
    """Numbers of tokens: the frequent pre-tokens, and behind them a cache of those met by this worker, emptied when full."""

    def __init__(self, pieces: np.ndarray, tokens: np.ndarray, path: str):
        super().__init__(zip(pieces.tolist(), tokens.tolist()))
        self.met: dict[str, int] = {}
        self.vocab = bpe.vocabulary(path)

    def __missing__(self, piece: str) -> int:
        found = self.met.get(piece)
        if found is None:
            raw = piece.encode("utf-8", "surrogatepass")
            if len(raw) > bpe.WINDOW:
                return sum(1 for _ in self.vocab.encode_long(raw))
            if len(self.met) >= bpe.REMEMBERED:
                self.met.clear()
            found = self.met[piece] = len(self.vocab.encode_piece(raw))
        return found


_numbers = itertools.count()
_made: dict[int, Lengths] = {}


def _lengths(shared, path: str) -> Lengths:
    """This worker's table, made once for a broadcast."""
    if shared.id not in _made:
        _made.clear()
        _made[shared.id] = Lengths(*shared.value, path)
    return _made[shared.id]


class _Shared:
    """A broadcast with a number that workers know it by."""

    def __init__(self, broadcast, number: int):
        self.broadcast, self.id = broadcast, number

    @property
    def value(self):
        return self.broadcast.value


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, carry=()) -> DataFrame:
    """``row`` (id and ``carry``), ``n_bytes n_tokens over_limit`` for every row of ``df``.

    A null text is an empty one: no bytes, no tokens, not over the limit. Texts are counted whole, a chunk at a time whatever their length.
    Repeated rows and null ids are rows like others, columns of any name are carried in ``row``, an empty table gives an empty result.
    """
    shared = _Shared(df.sparkSession.sparkContext.broadcast(frequent(df, path, text_col)), next(_numbers))

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        vocab, find = bpe.vocabulary(path), _lengths(shared, path).__getitem__
        return pd.Series([
            sum(1 if isinstance(part, str) else sum(map(find, part)) for part in bpe.pieces(text or "", vocab)) for text in texts
        ], dtype="int64")

    rows = df.select(
        F.struct(F.col(id_col).alias("id"), *carry).alias("row"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"),
        count(F.col(text_col)).alias("n_tokens"),
    )
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = count_tokens(documents(spark, sf_dir, "doc_id", "text"), bpe.default_path())
    return found.select(F.col("row.id").alias("doc_id"), "n_bytes", "n_tokens", "over_limit")
