"""Approximate nearest neighbours: compare a query only with records that share a cell with it.

Cells: vectors are assigned to their closest centroid, and a query looks into its ``probes`` closest cells. ``choose_probes``
finds the number of probes for a wanted recall from exact searches. Records and queries are joined on the cell and on the tile
within it (see ``tiles``), so nothing outside a shared cell is compared, and a cell of a third of all rows is many tasks;
kept in a partition column, cells that no query probes are not read.

Further forms are in ``hashing`` (buckets and sketches of random projections) and ``quantised`` (short codes).
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from hybridframe.functions.columns import let
from hybridframe.functions.vectors import norm
from hybridframe.operators.nearest import DEFAULT_K, PRODUCTS, QUERY_ID, attach, nearest_ids, query_shape, with_vectors
from hybridframe.operators.retrieve import select_records
from hybridframe.operators.tiles import Compare, Tiled, nearest_in_grid, nearest_in_tiles
from hybridframe.plans.session import written
from hybridframe.schema import EMBEDDING, ID

# Up to this many centroids go to every task (25 MB at 64 components); with more of them vectors are assigned by a search in a grid.
BROADCAST_CENTROIDS = 1 << 16


class CellIndex(NamedTuple):
    """Records with their ``cell``, the centroids, and how many cells a query looks into."""

    records: DataFrame
    centroids: DataFrame
    probes: int


def unit_rows(x: np.ndarray, metric: str) -> np.ndarray:
    """Cells and buckets are Euclidean; for cosine all vectors are first brought to length 1."""
    if metric != "cosine":
        return x
    with np.errstate(divide="ignore", invalid="ignore"):
        return x / np.sqrt((x**2).sum(axis=1))[:, None]


def unit_column(vector: str, metric: str) -> Column:
    if metric != "cosine":
        return F.col(vector).cast("array<double>")
    return let(norm(vector), lambda length: F.transform(vector, lambda x: F.try_divide(x.cast("double"), length)))


def train_cells(df: DataFrame, cells: int, dimension: int, metric: str = "cosine", fraction: float = 1.0, seed: int = 7) -> DataFrame:
    """Centroids ``cell, vector`` by k-means. Training may use a fraction; search reads every record."""
    known = with_vectors(df, dimension)
    if fraction < 1.0:
        known = known.sample(fraction, seed)
    features = known.select(unit_column(EMBEDDING, metric).alias("unit")).filter("not exists(unit, x -> x is null)")
    model = KMeans(k=cells, seed=seed, maxIter=10).fit(features.select(array_to_vector("unit").alias("features")))
    rows = [(i, [float(x) for x in center]) for i, center in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(rows, "cell long, vector array<double>")


def closest_cells(df: DataFrame, vector: str, centroids: DataFrame, probes: int, metric: str = "cosine", name: str = "keys") -> DataFrame:
    """Add the numbers of the ``probes`` closest cells, closest first."""
    rows = centroids.orderBy("cell").limit(BROADCAST_CENTROIDS + 1).collect()
    if len(rows) > BROADCAST_CENTROIDS:
        return _assigned_in_grid(df, vector, centroids, probes, metric, name)
    cells, matrix = np.asarray([row["cell"] for row in rows], dtype=np.int64), np.asarray([row["vector"] for row in rows], dtype=np.float64)
    shared = df.sparkSession.sparkContext.broadcast((cells, matrix, (matrix**2).sum(axis=1)))

    @F.pandas_udf("array<long>")
    def closest(vectors: pd.Series) -> pd.Series:
        numbers, centers, squares = shared.value
        x = unit_rows(np.stack(vectors.to_numpy()).astype(np.float64), metric)
        step, found = max(1, PRODUCTS // len(numbers)), []
        for start in range(0, len(x), step):
            cost = squares[None, :] - 2.0 * (x[start : start + step] @ centers.T)
            found.extend(numbers[np.argsort(cost, axis=1, kind="stable")[:, :probes]])
        return pd.Series(found)

    # Marked non-deterministic so that the optimizer never copies the call into a filter.
    return df.withColumn(name, closest.asNondeterministic()(F.col(vector)))


def _assigned_in_grid(df: DataFrame, vector: str, centroids: DataFrame, probes: int, metric: str, name: str) -> DataFrame:
    """``closest_cells`` for any number of centroids: each vector searches among them."""
    rows = written(df.withColumn("_row", F.monotonically_increasing_id()))
    searched = centroids.select(F.lpad(F.col("cell").cast("string"), 19, "0").alias(ID), F.col("vector").alias(EMBEDDING))
    queries = rows.select(F.col("_row").alias(QUERY_ID), unit_column(vector, metric).alias("vector")).filter("not exists(vector, x -> x is null)")
    total, dimension = query_shape(queries)
    hits = nearest_in_grid(searched, queries, probes, "l2", total, dimension)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("rank", ID))), lambda hit: hit[ID].cast("long"))
    keys = hits.groupBy(F.col(QUERY_ID).alias("_row")).agg(ordered.alias(name))
    return rows.join(keys, "_row", "left").drop("_row")


def build_cells(df: DataFrame, centroids: DataFrame, dimension: int, metric: str = "cosine") -> DataFrame:
    """Records with their ``cell``. Write it partitioned by ``cell`` to let a search skip cells."""
    return closest_cells(with_vectors(df, dimension), EMBEDDING, centroids, 1, metric).withColumn("cell", F.get("keys", F.lit(0)))


def write_cells(indexed: DataFrame, path: str) -> None:
    """Keep records by cell. A cell is cut into files of similar size, however many records it holds."""
    indexed.drop("keys").hint("rebalance", "cell").sortWithinPartitions("cell").write.partitionBy("cell").parquet(path)


def search_cells(
    indexed: DataFrame, centroids: DataFrame, queries: DataFrame, probes: int, k: int, metric: str, dimension: int, where=None, where_document=None, **options
) -> Tiled:
    """The tiles' lists for every query within its probed cells, and the number of distances taken."""
    routed = closest_cells(queries.filter("vector is not null").select(QUERY_ID, "vector"), "vector", centroids, probes, metric)
    routed = routed.select(QUERY_ID, "vector", F.explode("keys").alias("cell"))
    candidates = select_records(with_vectors(indexed, dimension), None, where, where_document, **options)
    return nearest_in_tiles(candidates, routed, Compare(metric, k, dimension))


def nearest_in_cells(
    indexed: DataFrame,
    centroids: DataFrame,
    queries: DataFrame,
    probes: int,
    k: int = DEFAULT_K,
    metric: str = "cosine",
    where=None,
    include: Iterable[str] = (),
    where_document=None,
    **options,
) -> DataFrame:
    """The k closest records within the probed cells that pass the filters. Probing every cell gives the exact answer."""
    total, dimension = query_shape(queries)
    found = search_cells(indexed, centroids, queries, probes, k, metric, dimension, where, where_document, **options)
    return attach(found.ranked(k, metric), indexed, include, bound=k * total)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Per query, the share of its exact neighbours that the approximate search found as well."""
    found = approximate.select(QUERY_ID, ID, F.lit(1).alias("hit"))
    both = exact.select(QUERY_ID, ID).join(found, [QUERY_ID, ID], "left")
    return both.groupBy(QUERY_ID).agg(
        F.count(F.lit(1)).alias("k"),
        F.count("hit").alias("found"),
        (F.count("hit") / F.count(F.lit(1))).alias("recall"),
    )


def probes_needed(indexed: DataFrame, centroids: DataFrame, queries: DataFrame, k: int = DEFAULT_K, metric: str = "cosine") -> DataFrame:
    """``probes, neighbours, found``: how many of the exact k neighbours of all queries lie in the closest 1, 2, ... cells.

    One exact search answers for every number of probes: a neighbour is found from the place on
    that its cell has in the query's order of cells.
    """
    exact = nearest_ids(indexed, queries, k, metric).select(QUERY_ID, ID)
    cells = centroids.count()
    order = closest_cells(queries.filter("vector is not null").select(QUERY_ID, "vector"), "vector", centroids, cells, metric)
    order = order.select(QUERY_ID, F.posexplode("keys").alias("place", "cell"))
    places = exact.join(indexed.select(ID, "cell"), ID).join(order, [QUERY_ID, "cell"])
    counts = places.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    steps = indexed.sparkSession.range(1, cells + 1).withColumnRenamed("id", "probes")
    return steps.join(F.broadcast(counts), F.col("place") < F.col("probes"), "left").groupBy("probes").agg(
        F.lit(exact.count()).cast("long").alias("neighbours"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("found")
    )


def lower_bound(found: int, tried: int, risk: float) -> float:
    """The exact binomial (Clopper-Pearson) lower bound of a share: below it, ``found`` or more would happen with a probability of ``risk`` at most."""
    if not found:
        return 0.0

    def tail(p: float) -> float:
        logs = [
            math.lgamma(tried + 1) - math.lgamma(i + 1) - math.lgamma(tried - i + 1) + i * math.log(p) + (tried - i) * math.log1p(-p)
            for i in range(found, tried + 1)
        ]
        return math.fsum(math.exp(x) for x in logs)

    low, high = 0.0, 1.0
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (low, middle) if tail(middle) > risk else (middle, high)
    return low


def choose_probes(
    indexed: DataFrame, centroids: DataFrame, queries: DataFrame, wanted: float = 0.9, k: int = DEFAULT_K, metric: str = "cosine", risk: float = 0.05
) -> DataFrame:
    """One row ``probes, recall, bound``: the smallest number of probes whose recall is at least ``wanted`` but for a ``risk``.

    ``queries`` are searched exactly. The bound is the binomial one on the share of queries that get ``wanted`` of their neighbours
    on average: neighbours of a query are not independent, so queries are what is counted, each with the part of its neighbours that
    is found, rounded down to whole queries. Numbers of probes are tried from many to few in a fixed order, and the last one that holds
    is taken, so no correction for the number of tests is needed. Probing all cells always holds.
    """
    asked = query_shape(queries)[0]
    rows = sorted((r["probes"], r["neighbours"], r["found"]) for r in probes_needed(indexed, centroids, queries, k, metric).collect())
    chosen = None
    for probes, neighbours, found in reversed(rows):
        share = found / neighbours if neighbours else 1.0
        bound = 1.0 if probes == rows[-1][0] else lower_bound(math.floor(asked * share), asked, risk)
        if bound < wanted:
            break
        chosen = (probes, share, bound)
    return indexed.sparkSession.createDataFrame([chosen] if chosen else [], "probes long, recall double, bound double")
