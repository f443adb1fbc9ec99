"""Indexes that stay right after records change: what left and what came is put beside the stored index, and corrected when it is read.

``minus`` are the records as they were, ``plus`` as they are now; a changed record is in both. They are as many as the change has rows, whatever the index holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from hybridframe.operators.approximate import CellIndex, closest_cells
from hybridframe.operators.fulltext import TextIndex, _part, document_frequencies, postings
from hybridframe.operators.joins import join_small
from hybridframe.operators.nearest import with_vectors
from hybridframe.plans.session import written
from hybridframe.schema import DOCUMENT, EMBEDDING, ID


def changed_records(old: DataFrame, new: DataFrame, columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """``minus`` and ``plus``: the rows of either side without an equal row (id and ``columns``) on the other one."""

    def without(one: DataFrame, other: DataFrame) -> DataFrame:
        same = other.select(F.col(ID).alias("_same"), *[F.col(c).alias(f"_same_{c}") for c in columns])
        equal = one[ID] == same["_same"]
        for c in columns:
            equal = equal & one[c].eqNullSafe(same[f"_same_{c}"])
        return one.join(same, equal, "left_anti")

    return without(old, new), without(new, old)


def _without(stored: DataFrame, minus: DataFrame, plus: DataFrame) -> DataFrame:
    """Stored rows of records that did not change."""
    gone = minus.select(ID).unionByName(plus.select(ID)).distinct()
    return join_small(stored, gone, ID, "left_anti")


def text_index_after(index: TextIndex, minus: DataFrame, plus: DataFrame) -> TextIndex:
    """The index as if it had been built after the change: postings, document frequencies, number and mean length of documents.

    A document that is new and was there unchanged before, or the same change given twice, is the caller's to avoid (see ``changed_records``).
    """
    # read by the postings, the frequencies and the lengths, and cut once
    won = written(postings(plus))
    lost = written(postings(minus).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf")))
    if index.parts is not None:
        won = won.withColumn("part", _part(F.col("term"), index.parts))
    posted = _without(index.postings, minus, plus).unionByName(won)
    shift = document_frequencies(won).unionByName(lost.select("term", (-F.col("df")).alias("df")))
    frequencies = index.frequencies.unionByName(shift).groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")
    texts = lambda df, sign: df.filter(F.col(DOCUMENT).isNotNull()).select(F.lit(sign).cast("long").alias("n"), F.lit(0.0).alias("length"))
    terms = lambda counted, sign: counted.select(F.lit(0).cast("long").alias("n"), (F.col("tf") * sign).cast("double").alias("length"))
    base = index.corpus.select("n", (F.col("n") * F.coalesce("average", F.lit(0.0))).alias("length"))
    # the stored mean times the number is a whole number of terms but for rounding
    base = base.select("n", F.round("length").alias("length"))
    total = reduce(DataFrame.unionByName, [base, texts(plus, 1), texts(minus, -1), terms(won, 1), terms(lost, -1)])
    total = total.agg(F.sum("n").alias("n"), F.sum("length").alias("length"))
    return TextIndex(posted, frequencies, total.select("n", F.try_divide("length", F.col("n")).alias("average")), index.parts)


def cells_after(cells: CellIndex, minus: DataFrame, plus: DataFrame, dimension: int, metric: str) -> CellIndex:
    """The cells with changed records taken out and put into their closest cells. The centroids stay as they were trained."""
    kept = _without(cells.records, minus, plus)
    columns = [c for c in cells.records.columns if c != "cell"]
    came = closest_cells(with_vectors(plus, dimension).select(*columns), EMBEDDING, cells.centroids, 1, metric)
    came = came.select(*columns, F.get("keys", F.lit(0)).cast(cells.records.schema["cell"].dataType).alias("cell"))
    return CellIndex(kept.unionByName(came), cells.centroids, cells.probes)
