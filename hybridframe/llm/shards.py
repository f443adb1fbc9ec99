"""Shards of nearly equal bytes: a minimax partition of ordered groups into contiguous runs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hybridframe.llm.common import documents, query, stage, text_or_empty

SHARDS = 8
# Hexadecimal digits by which a cell of groups is told from its neighbours, level by level: 4,096 cells from one.
DIGITS = 3


def greedy(sizes: np.ndarray, capacity: int) -> list[int]:
    """Where each run starts when runs are filled up to the capacity one after the other."""
    ends, starts, at = np.cumsum(sizes), [], 0
    while at < len(sizes):
        starts.append(at)
        before = ends[at - 1] if at else 0
        at = max(at + 1, int(np.searchsorted(ends, before + capacity, "right")))
    return starts


def smallest_capacity(sizes: np.ndarray, shards: int, least: int) -> int:
    """The smallest capacity with which no more than ``shards`` runs are needed, by binary search."""
    low, high = max(least, -(-int(sizes.sum()) // shards)), int(sizes.sum())
    while low < high:
        middle = (low + high) // 2
        if len(greedy(sizes, middle)) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def cuts(groups: DataFrame, shards: int = SHARDS) -> tuple[int, list[str]]:
    """The minimax capacity and the key prefixes at which shards 1, 2, ... start.

    ``groups`` has ``key`` (hexadecimal) and ``size``. Sums for cells of neighbouring keys are looked at first.
    The capacity lies between what fractions of groups would need and what whole cells need; only cells in which a run
    can end for such a capacity are divided further, at most two per run and level. So the driver holds
    some 4,096 cells for each of these, whatever the input, and the result is exact.
    """

    def cells_of(rows: DataFrame, digits: int) -> list[tuple]:
        cell = F.substring("key", 1, digits).alias("cell")
        found = rows.groupBy(cell).agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.max("size").alias("most"))
        return [tuple(row) for row in found.collect()]

    digits = DIGITS
    cells = sorted(cells_of(groups, digits))
    while cells:
        sizes = np.array([c[1] for c in cells], np.int64)
        least = max(c[3] for c in cells)
        low = max(least, -(-int(sizes.sum()) // shards))
        high = smallest_capacity(sizes, shards, int(sizes.max()))
        ends, wanted, first, last = np.cumsum(sizes), set(), 0, 0
        for _ in range(shards):  # the k-th run ends between these two
            lower = int(np.searchsorted(ends, first + low, "right"))
            last = last + high
            upper = int(np.searchsorted(ends, last, "right"))
            wanted.update(range(lower, min(upper, len(cells) - 1) + 1))
            first = int(ends[lower - 1]) if lower else 0
        open_cells = [cells[i][0] for i in sorted(wanted) if i < len(cells) and cells[i][2] > 1]
        if not open_cells:
            capacity = smallest_capacity(sizes, shards, least)
            return capacity, [cells[i][0] for i in greedy(sizes, capacity)][1:]
        digits += DIGITS
        inner = groups
        if len(open_cells) <= 2048:
            inner = groups.filter(F.substring("key", 1, digits - DIGITS).isin(open_cells))
        divided = set(open_cells)
        inner_cells = [c for c in cells_of(inner, digits) if c[0][: digits - DIGITS] in divided]
        cells = sorted([c for c in cells if c[0] not in divided] + inner_cells)
    return 0, []


def shard(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, carry=()) -> DataFrame:
    """``row`` (id and ``carry``), ``size text_crc32 shard slot`` for every row of ``df``.

    A size is the text's UTF-8 bytes plus 1. Rows of equal texts are a group that is never divided; groups are ordered by the
    SHA-256 of the text, so that a row finds its shard from its own text and seven cut points, without a join. Shards are runs
    of this order, cut so that the largest is as small as can be. A slot is the place in the shard, from 0.

    A null text is an empty one. Rows that repeat an id have slots of their own. With fewer groups than
    shards the last shards are empty; an empty table has no rows.
    """
    binary = text_or_empty(text_col).cast("binary")
    rows = stage(
        df.select(
            F.struct(F.col(id_col).alias("id"), *carry).alias("row"),
            F.col(id_col).alias("id"),
            (F.octet_length(binary) + F.lit(1)).cast("long").alias("size"),
            F.crc32(binary).alias("text_crc32"),
            F.sha2(binary, 256).alias("key"),
        )
    )
    groups = stage(rows.groupBy("key").agg(F.sum("size").alias("size")))
    _, starts = cuts(groups, shards)
    number = sum(((F.col("key") >= start).cast("int") for start in starts), F.lit(0))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.withColumn("shard", number).repartitionByRange(partitions, "key", "id").sortWithinPartitions("key", "id")
    place = F.monotonically_increasing_id()
    ordered = stage(ordered.drop("key", "id").withColumn("part", F.spark_partition_id()).withColumn("place", place))
    # one row for each shard of each partition: a few more than there are partitions
    runs = ordered.groupBy("shard", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    placed = ordered.join(F.broadcast(runs), ["shard", "part"])
    return placed.select("row", "size", "text_crc32", "shard", (F.col("place") + F.col("shift")).alias("slot"))


@query("op1_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard(documents(spark, sf_dir, "doc_id", "text"))
    return found.select(
        F.col("row.id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
