"""Filtered retrieval, pages and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hybridframe.functions.predicates import selection
from hybridframe.functions.records import metadata_or_empty
from hybridframe.operators.joins import join_small
from hybridframe.schema import DOCUMENT, EMBEDDING, ID, METADATA, included

DEFAULT_PAGE = 100


def project(df: DataFrame, include=None, extra: tuple[str, ...] = ()) -> DataFrame:
    """The id, any ``extra`` columns, and the record columns asked for."""
    columns = [F.col(ID), *[F.col(name) for name in extra]]
    for field in included(include):
        columns.append(metadata_or_empty(F.col(field)).alias(field) if field == METADATA else F.col(field))
    return df.select(*columns)


def select_records(df: DataFrame, ids=None, where=None, where_document=None, **options) -> DataFrame:
    """Records that pass all of the given conditions.

    ``ids`` is a string, a list, or a DataFrame with an ``_id`` column for id sets too long for a
    literal list.
    """
    if isinstance(ids, DataFrame):
        df = join_small(df, ids.select(ID).distinct(), ID, "left_semi")
        ids = None
    if ids is None and not where and not where_document:
        return df
    return df.filter(selection(where, where_document, ids, **options))


def page(df: DataFrame, limit: int | None = None, offset: int | None = None) -> DataFrame:
    """One page in id order. The cost grows with the offset; walk long lists with ``page_after``, jump with ``deep_page``."""
    limit = DEFAULT_PAGE if limit is None else limit
    ordered = df.orderBy(ID)
    if offset:
        ordered = ordered.offset(offset)
    return ordered.limit(limit)


def page_after(df: DataFrame, last_id: str | None = None, limit: int = DEFAULT_PAGE) -> DataFrame:
    """The page that follows ``last_id``. Every page costs the same, however deep it lies."""
    rest = df if last_id is None else df.filter(F.col(ID) > F.lit(last_id))
    return rest.orderBy(ID).limit(limit)


def write_pages(df: DataFrame, path: str, parts: int = 64) -> None:
    """Keep the ids in order, by range, with the number of ids in each range, for ``deep_page``."""
    ordered = df.select(ID).repartitionByRange(parts, ID).sortWithinPartitions(ID).withColumn("range", F.spark_partition_id())
    ordered.write.partitionBy("range").parquet(f"{path}/ids")
    df.sparkSession.read.parquet(f"{path}/ids").groupBy("range").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/counts")


def deep_page(df: DataFrame, path: str, limit: int = DEFAULT_PAGE, offset: int = 0) -> DataFrame:
    """``page`` where ``write_pages`` was called: sums of the counts tell in which ranges the page lies, and only these are read.

    The counts are one row for each range.
    """
    pages, before, wanted = df.sparkSession.read.parquet(f"{path}/ids"), 0, []
    for row in df.sparkSession.read.parquet(f"{path}/counts").orderBy("range").collect():
        if before < offset + limit and before + row["n"] > offset:
            wanted.append((row["range"], before))
        before += row["n"]
    ids = pages.filter(F.col("range").isin([number for number, _ in wanted])).select(ID)
    ids = ids.orderBy(ID).offset(offset - wanted[0][1] if wanted else 0).limit(limit)
    return join_small(df, ids, ID, "left_semi", bound=limit).orderBy(ID)


def get(df: DataFrame, ids=None, where=None, where_document=None, limit=None, offset=None, include=None, **options) -> DataFrame:
    """Filtered page of records in id order."""
    return page(project(select_records(df, ids, where, where_document, **options), include), limit, offset)


def peek(df: DataFrame, limit: int = 10) -> DataFrame:
    return page(project(df, ("documents", "metadatas", "embeddings")), limit)


def count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, name: str, dimension: int, distance: str) -> DataFrame:
    """One row: what the collection is called, how it measures, and how full its columns are."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in (DOCUMENT, EMBEDDING, METADATA)]
    return df.agg(F.count(F.lit(1)).alias("n"), *nulls).select(
        F.lit(name).alias("name"), F.lit(dimension).alias("dimension"), F.lit(distance).alias("distance"), "*"
    )
