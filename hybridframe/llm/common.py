"""What the operators of this subpackage share: staging, joins that know their hot keys, words, registration."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from hybridframe.plans.session import shared_folder, ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The keys of a join that are broadcast: no more than these, and no more bytes, at their largest.
HOT_KEYS, BROADCAST_BYTES = 1000, 32 << 20

# A word is a run of anything but these, in Java's and DuckDB's notation.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL where SQL can say it."""

    def register(run: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[name] = prepared
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: one evaluation, no lineage, survives lost executors.

    What was shuffled for it is not needed afterwards, so Spark is asked to remove it at once.
    """
    spark, cleanup = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = shared_folder(spark), spark.conf.get(cleanup)
    if getattr(_noting, "folders", None) is not None:
        _noting.folders.append(path)
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, *measures: Column) -> tuple[DataFrame, dict]:
    """``stage``, and what the named aggregates ``measures`` give for its rows, from the same pass."""
    seen = Observation()
    staged = stage(df.observe(seen, *measures))
    return staged, seen.get


_noting = threading.local()


@contextmanager
def noted() -> Iterator[list[str]]:
    """The folders of the tables that this thread stages meanwhile, for ``remove``."""
    before, folders = getattr(_noting, "folders", None), []
    _noting.folders = folders
    try:
        yield folders
    finally:
        _noting.folders = before


def remove(spark: SparkSession, folders: list[str]) -> None:
    """Delete staged tables that nothing will read any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int, row_bytes: int) -> DataFrame:
    """Left join of ``rows`` with ``groups``, which has one row per key and the key's number of rows in ``size``.

    Keys that hold more than 1 / ``HOT_KEYS`` of all rows are broadcast (or fewer, where ``row_bytes`` are
    many): there can be only ``HOT_KEYS`` of them, of at most ``row_bytes`` each, whatever the input.
    Rows of the other keys are shuffled, where no key is large, in the same way for small and large inputs. ``groups`` should be staged.
    """
    most = max(1, min(HOT_KEYS, BROADCAST_BYTES // row_bytes))
    hot = F.col(size) * F.lit(most) > F.lit(total)
    few, many = F.broadcast(groups.filter(hot)), groups.filter(~hot)
    return rows.join(few, on, "inner").unionByName(rows.join(few.select(*on), on, "left_anti").join(many.hint("shuffle_merge"), on, "left"))
