"""Keyed changes as DataFrame to DataFrame functions: current records and a batch give new records.

A batch has ``_id`` and any of ``document, embedding, metadata``; a null field means "leave alone".
Where an id comes more than once, ``position`` orders its entries, later ones over earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from hybridframe.functions.predicates import selection
from hybridframe.operators.joins import join_small
from hybridframe.operators.retrieve import select_records
from hybridframe.plans.session import written
from hybridframe.schema import DOCUMENT, EMBEDDING, FIELDS, ID, METADATA, conform

CHANGEABLE = (DOCUMENT, EMBEDDING, METADATA)


def fold(batch: DataFrame) -> DataFrame:
    """One row per id: for every field its last value that is not null.

    Rows of a DataFrame have no order of their own, so a batch without ``position`` that repeats an id fails.
    """
    if "position" not in batch.columns:
        repeated = F.raise_error(F.concat(F.lit("position is needed, since an id comes twice: "), F.col(ID)))
        single = conform(batch).groupBy(ID).agg(F.count("*").alias("n"), *[F.first(field).alias(field) for field in CHANGEABLE])
        checked = F.when(F.col("n") == 1, F.col(ID)).otherwise(repeated.cast("string"))
        return single.select(checked.alias(ID), *CHANGEABLE)
    latest = [F.expr(f"max_by({field}, position) filter (where {field} is not null)").alias(field) for field in CHANGEABLE]
    return batch.groupBy(ID).agg(*latest).select(*FIELDS)


def duplicates(current: DataFrame, batch: DataFrame, bound: int | None = None) -> DataFrame:
    """``_id, in_batch, stored`` for ids that an add must refuse."""
    counted = batch.groupBy(ID).agg(F.count(F.lit(1)).alias("in_batch"))
    stored = join_small(current.select(ID), counted.select(ID), ID, "left_semi", bound=bound).withColumn("stored", F.lit(True))
    return (
        counted.join(stored, ID, "left")
        .select(ID, "in_batch", F.coalesce("stored", F.lit(False)).alias("stored"))
        .filter("in_batch > 1 or stored")
    )


def add(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Append a batch whose ids are new; check with ``duplicates`` first."""
    return conform(current).unionByName(conform(batch))


def _overlay(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Current records with the fields that the batch gives.

    The join has no hint: a batch carries whole texts and vectors, so its bytes decide, and Spark
    broadcasts it only below its own threshold.
    """
    new = batch.select(ID, *[F.col(field).alias(f"_new_{field}") for field in CHANGEABLE])
    joined = conform(current).join(new, ID, "left")
    merged = [F.coalesce(F.col(f"_new_{field}"), F.col(field)).alias(field) for field in CHANGEABLE]
    return joined.select(ID, *merged)


def update(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Replace the given fields of existing records. Ids that do not exist are passed over."""
    return _overlay(current, fold(batch))


def missing(current: DataFrame, batch: DataFrame, bound: int | None = None) -> DataFrame:
    """Ids of a batch that no record has."""
    wanted = batch.select(ID).distinct()
    known = join_small(current.select(ID), wanted, ID, "left_semi", bound=bound)
    return wanted.join(known, ID, "left_anti")


def upsert(current: DataFrame, batch: DataFrame, bound: int | None = None) -> DataFrame:
    """Update the records that exist, insert the others.

    With a small batch the current records are only scanned: the batch is broadcast to them for the
    overlay and for finding the known ids. A full outer join would shuffle every record.
    """
    # read by the overlay, by the search for known ids and by the rows that are new
    folded = written(fold(batch))
    known = join_small(current.select(ID), folded.select(ID), ID, "left_semi", bound=bound)
    return _overlay(current, folded).unionByName(folded.join(known, ID, "left_anti"))


def replace_sources(current: DataFrame, batch: DataFrame, source: Callable[[Column], Column]) -> DataFrame:
    """Records with all of those of the batch's sources replaced by the batch: what a source does not hold any more goes.

    ``source`` makes the source from the metadata. A record without one stays.
    """
    sources = batch.select(source(F.col(METADATA)).alias("_source")).filter("_source is not null").distinct()
    marked = conform(current).withColumn("_source", source(F.col(METADATA)))
    return join_small(marked, sources, "_source", "left_anti").select(*FIELDS).unionByName(fold(batch))


def delete(current: DataFrame, ids=None, where=None, where_document=None, **options) -> DataFrame:
    """Records that remain. A record whose condition is NULL remains too."""
    if ids is None and not where and not where_document:
        raise ValueError("delete needs ids, where or where_document")
    if not isinstance(ids, DataFrame):
        return current.filter(~F.coalesce(selection(where, where_document, ids, **options), F.lit(False)))
    wanted = ids.select(ID).distinct()
    if not where and not where_document:
        return join_small(current, wanted, ID, "left_anti")
    marked = join_small(current, wanted.withColumn("_wanted", F.lit(True)), ID, "left")
    condition = F.col("_wanted") & selection(where, where_document, **options)
    return marked.filter(~F.coalesce(condition, F.lit(False))).drop("_wanted")


def selected_for_delete(current: DataFrame, ids=None, where=None, where_document=None, **options) -> DataFrame:
    """The records that ``delete`` with the same arguments removes."""
    return select_records(current, ids, where, where_document, **options)
