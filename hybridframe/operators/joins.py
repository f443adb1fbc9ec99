"""Joins that decide by a checked size, and ranking within a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A side of at most this many narrow rows is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 200_000
SALTS = 64


def is_small(df: DataFrame) -> bool:
    """Whether ``df`` may be broadcast. Reads no more rows than it needs to know."""
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def join_small(
    large: DataFrame,
    small: DataFrame,
    on: str,
    how: str = "inner",
    *,
    bound: int | None = None,
    salt_by: Column | None = None,
) -> DataFrame:
    """Join on one column, broadcasting ``small`` only when its size is known to allow it.

    ``bound`` is a number of rows that ``small`` cannot exceed; without one the rows are counted.
    A side that is too large is shuffled instead. Where the key may repeat in ``large``, give
    ``salt_by``: the rows of one key are then spread over many tasks by its hash, and ``small`` is
    repeated once per salt.
    """
    fits = bound <= BROADCAST_ROWS if bound is not None else is_small(small)
    if fits:
        return large.join(F.broadcast(small), on, how)
    if salt_by is None:
        return large.join(small, on, how)
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")


def top_per_group(df: DataFrame, group: str, order: list[Column], k, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of every group, numbered from 1.

    Spark cuts each map partition to k rows per group before the shuffle (WindowGroupLimit), so a
    group that holds most of the rows still sends only k of them per partition.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
