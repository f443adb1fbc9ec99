"""Approximate search by random projections that are calibrated on the data.

The signs of a vector's projections are its sketch. Its first signs name a bucket; a query looks into its own bucket and into those whose
signs differ where its projections are closest to zero, cheapest first. Within a bucket sketches are compared, and a distance is taken only
where they differ in at most ``radius`` signs. How many signs, buckets and differences are needed for a wanted recall is
estimated from exact neighbours of sampled queries; nothing is dropped but by these three numbers.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hybridframe.operators import tiles
from hybridframe.operators.approximate import unit_rows
from hybridframe.operators.nearest import DEFAULT_K, PRODUCTS, QUERY_ID, NearestLists, attach, matrix_of, nearest_ids, query_shape, with_vectors
from hybridframe.operators.tiles import Compare, Tiled, nearest_in_tiles
from hybridframe.schema import EMBEDDING, ID

# What calibration reads: this many queries with their exact neighbours, and this many other records.
SAMPLED_QUERIES, SAMPLED_RECORDS = 256, 4096
SKETCHES, PREFIXES = (64, 128, 256, 512, 1024), (2, 4, 6, 8, 10, 12)
# Sending a query to one more bucket costs as much as looking at so many records.
PROBE = 64
# Pairs of sketches that are compared at a time, so that what is in between stays in a core's cache.
STEP = 1 << 15


class Projections(NamedTuple):
    """Random directions, and how they are used."""

    planes: np.ndarray  # components x signs of a sketch
    centre: np.ndarray  # taken off first, so that signs are balanced
    prefix: int  # signs that name a bucket
    buckets: int  # buckets that a query looks into
    radius: int  # signs in which compared sketches differ at most
    expected_recall: float
    expected_share: float


def _signs(x: np.ndarray, model: Projections, metric: str) -> np.ndarray:
    return (unit_rows(x, metric) - model.centre) @ model.planes


def _sketch(signs: np.ndarray) -> np.ndarray:
    packed = np.packbits(signs > 0, axis=1)
    return np.ascontiguousarray(packed).view(np.uint64)


def _numbers(signs: np.ndarray, prefix: int) -> np.ndarray:
    return (signs[:, :prefix] > 0) @ (1 << np.arange(prefix))


def probe_order(signs: np.ndarray, prefix: int, buckets: int) -> np.ndarray:
    """For every row the ``buckets`` cheapest buckets: the cost is the sum of the squared projections whose signs are turned."""
    masks = np.arange(1 << prefix)
    turned = ((masks[:, None] >> np.arange(prefix)) & 1).astype(np.float64)
    cost = signs[:, :prefix] ** 2 @ turned.T
    return _numbers(signs, prefix)[:, None] ^ np.argsort(cost, axis=1, kind="stable")[:, :buckets]


def probed(signs: np.ndarray, prefix: int, buckets: int) -> np.ndarray:
    """``probe_order`` as a table: for every row and number of a bucket whether it is among the cheapest."""
    masks, inside = np.arange(1 << prefix), np.zeros((len(signs), 1 << prefix), bool)
    turned = ((masks[:, None] >> np.arange(prefix)) & 1).astype(np.float64)
    home, step = _numbers(signs, prefix), max(1, PRODUCTS >> prefix)
    for start in range(0, len(signs), step):
        cost = signs[start : start + step, :prefix] ** 2 @ turned.T
        last = np.partition(cost, buckets - 1, axis=1)[:, buckets - 1 : buckets]
        cheap, equal = cost < last, cost == last
        # of equal costs the first ones, as a stable sort has them
        cheap |= equal & (np.cumsum(equal, axis=1) <= buckets - cheap.sum(axis=1, keepdims=True))
        inside[start : start + step] = np.take_along_axis(cheap, home[start : start + step, None] ^ masks, axis=1)
    return inside


def calibrate(df: DataFrame, dimension: int, metric: str = "cosine", k: int = DEFAULT_K, wanted: float = 0.95, most: float = 0.2, seed: int = 7) -> Projections:
    """Projections whose expected recall is ``wanted``, with the shortest sketch that takes a distance for at most ``most`` of all pairs.

    ``SAMPLED_QUERIES`` records (by a hash of their ids) are searched exactly among all records, and compared with ``SAMPLED_RECORDS``
    others: both are bounded, so is what the driver holds. Half of the allowed loss goes to the buckets, half to the radius. The prefix is
    the one with the least work for a query: the records in its probed buckets, and ``PROBE`` more for each bucket, as the query goes to all of
    them. Where no sketch reaches ``most`` the longest is used.
    """
    known = with_vectors(df, dimension).select(ID, EMBEDDING)
    drawn = known.orderBy(F.xxhash64(F.lit(seed), ID), ID)
    queries = drawn.limit(SAMPLED_QUERIES).select(F.monotonically_increasing_id().alias(QUERY_ID), F.col(EMBEDDING).cast("array<double>").alias("vector"), ID)
    own = queries.collect()
    asked = df.sparkSession.createDataFrame([(i, row["vector"]) for i, row in enumerate(own)], f"{QUERY_ID} long, vector array<double>")
    near = nearest_ids(known, asked, k + 1, metric).join(known, ID).select(QUERY_ID, ID, EMBEDDING).collect()
    others = np.array([row[EMBEDDING] for row in drawn.limit(SAMPLED_QUERIES + SAMPLED_RECORDS).collect()[len(own) :]] or [[0.0] * dimension], dtype=np.float64)
    x, of = np.array([row["vector"] for row in own]), np.array([row[QUERY_ID] for row in near if own[row[QUERY_ID]][ID] != row[ID]], dtype=np.int64)
    neighbours = np.array([row[EMBEDDING] for row in near if own[row[QUERY_ID]][ID] != row[ID]], dtype=np.float64).reshape(-1, dimension)
    random = np.random.default_rng(seed)
    unit = unit_rows(np.concatenate([x, others]), metric)
    model = Projections(random.normal(size=(dimension, max(SKETCHES))), np.nan_to_num(unit).mean(axis=0), 0, 1, 0, 1.0, 1.0)
    one, two, rest = (_signs(v, model, metric) for v in (x, neighbours, others))
    share = 1 - (1 - wanted) / 2
    # buckets: the least work for the wanted share of the neighbours
    best, held, count = (np.inf, 0, 1, 1.0), None, known.count()
    for prefix in PREFIXES:
        order = probe_order(one, prefix, 1 << prefix)
        place = np.argmax(order[of] == _numbers(two, prefix)[:, None], axis=1) if len(of) else np.zeros(1, int)
        buckets = int(np.sort(place)[_at(place, share)]) + 1
        inside = np.zeros((len(x), 1 << prefix), bool)
        np.put_along_axis(inside, order[:, :buckets], True, axis=1)
        looked = inside[:, _numbers(rest, prefix)]
        work = float(looked.mean()) * count + PROBE * buckets
        if work < best[0]:
            best, held = (work, prefix, buckets, float((place < buckets).mean())), looked
    _, prefix, buckets, kept = best
    for size in SKETCHES:
        a, b, c = (_sketch(s[:, :size]) for s in (one, two, rest))
        apart = np.bitwise_count(a[of] ^ b).sum(axis=1, dtype=np.int64) if len(of) else np.zeros(1, np.int64)
        radius = int(np.sort(apart)[_at(apart, share)])
        close = np.stack([np.bitwise_count(row ^ c).sum(axis=1, dtype=np.int64) <= radius for row in a])
        taken = float((close & held).mean())
        chosen = Projections(model.planes[:, :size], model.centre, prefix, buckets, radius, kept * float((apart <= radius).mean()), taken)
        if taken <= most:
            break
    return chosen


def _at(values: np.ndarray, share: float) -> int:
    """The place in sorted values up to which the share lies."""
    return min(len(values) - 1, int(np.ceil(len(values) * share)))


class CompareSketches(Compare):
    """Distances only in the probed buckets and where the sketches are close, of which those are counted."""

    def __init__(self, metric: str, k: int, dimension: int, model: Projections):
        super().__init__(metric, k, dimension)
        self.model = model

    def prepare(self, ids: list, vectors: np.ndarray) -> NearestLists:
        signs = _signs(vectors, self.model, self.metric)
        self.sketches, self.inside = _sketch(signs), probed(signs, self.model.prefix, self.model.buckets)
        return super().prepare(ids, vectors)

    def distinct(self, left: pa.Table) -> pa.Table:
        """All records, as each is counted, by their buckets."""
        signs = _signs(self.values(left.column(self.column).combine_chunks()), self.model, self.metric)
        return left.take(pa.array(np.argsort(_numbers(signs, self.model.prefix), kind="stable")))

    def tile(self, ids: pa.Array, records: pa.Array, lists: NearestLists) -> int:
        x, compared = matrix_of(records, self.dimension), 0
        signs = _signs(x, self.model, self.metric)
        mine, numbers = _sketch(signs), _numbers(signs, self.model.prefix)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(numbers)) + 1, [len(x)]])

        def close(part: slice) -> np.ndarray:
            nonlocal compared
            near = np.zeros((len(self.sketches[part]), len(x)), bool)
            for low, high in zip(edges, edges[1:]):
                asked, step = np.flatnonzero(self.inside[part, numbers[low]]), max(1, STEP // (high - low))
                for at in range(0, len(asked), step):
                    near[asked[at : at + step], low:high] = alike(self.sketches[part][asked[at : at + step]], mine[low:high])
            compared += int(np.count_nonzero(near))
            return near

        def alike(theirs: np.ndarray, own: np.ndarray) -> np.ndarray:
            differ = np.zeros((len(theirs), len(own)), np.uint16)
            for word in range(own.shape[1]):
                differ += np.bitwise_count(theirs[:, word, None] ^ own[None, :, word])
            return differ <= self.model.radius

        lists.compare(ids, x, close)
        return compared


def with_buckets(df: DataFrame, vector: str, model: Projections, metric: str, buckets: int = 1, shift: int = 0) -> DataFrame:
    """A row for each ``cell`` with one of the ``buckets`` cheapest buckets of a vector; a cell is ``2 ** shift`` buckets."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<long>")
    def numbers(vectors: pd.Series) -> pd.Series:
        own = shared.value
        signs = _signs(np.stack(vectors.to_numpy()).astype(np.float64), own, metric)
        if buckets == 1:
            return pd.Series(list((_numbers(signs, own.prefix)[:, None] >> shift).astype(np.int64)))
        cells = probed(signs, own.prefix, buckets).reshape(len(signs), -1, 1 << shift).any(axis=2)
        return pd.Series([np.flatnonzero(row).astype(np.int64) for row in cells])

    return df.withColumn("_cells", numbers.asNondeterministic()(F.col(vector))).withColumn("cell", F.explode("_cells")).drop("_cells")


def search_buckets(df: DataFrame, model: Projections, queries: DataFrame, dimension: int, k: int, metric: str) -> Tiled:
    """The tiles' lists, and the number of distances taken.

    Buckets with consecutive numbers are one cell, as many of them as make a tile's records, so a query is sent to a cell once and not
    to each of its buckets; in a tile it meets the records of its own buckets only.
    """
    known = with_vectors(df, dimension).select(ID, EMBEDDING)
    shift = max(0, model.prefix - (known.count() // tiles.RECORDS).bit_length())
    records = with_buckets(known, EMBEDDING, model, metric, 1, shift)
    asked = with_buckets(queries.filter("vector is not null").select(QUERY_ID, "vector"), "vector", model, metric, model.buckets, shift)
    return nearest_in_tiles(records, asked, CompareSketches(metric, k, dimension, model))


def nearest_in_buckets(
    df: DataFrame, model: Projections, queries: DataFrame, dimension: int, k: int = DEFAULT_K, metric: str = "cosine", include: Iterable[str] = ()
) -> DataFrame:
    """The k closest of the records in the probed buckets whose sketches are close to the query's."""
    total, _ = query_shape(queries)
    return attach(search_buckets(df, model, queries, dimension, k, metric).ranked(k, metric), df, include, bound=k * total)
