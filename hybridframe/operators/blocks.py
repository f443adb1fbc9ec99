"""Postings in blocks of documents, each with its largest weight: a ranked search that leaves out blocks that cannot reach its k best.

Documents are put in order of length and numbered; ``DOCUMENTS`` of them are a block. A stored row holds the postings of one term in one block
and the largest weight among them. What the largest weights of a text's terms add up to bounds every score in the block. A first job scores the blocks with
the highest bounds, whose k-th score is a threshold; a second one scores all blocks whose bound reaches it. Both give whole scores, so the result is that of
scoring everything.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hybridframe.functions.columns import steady
from hybridframe.functions.predicates import contained_terms, only_contains, where_document as document_predicate
from hybridframe.functions.text import tokens
from hybridframe.operators.fulltext import PARTS, _idf, _part, _weight, corpus, postings
from hybridframe.operators.joins import join_small, top_per_group
from hybridframe.operators.nearest import QUERY_ID
from hybridframe.plans.session import written
from hybridframe.schema import DOCUMENT, ID

# Documents of a block as a power of two; blocks that the first job scores.
BLOCK_BITS, FIRST = 5, 32
# A bound may be below a score by the rounding of its sum.
SLACK = 1.0 - 1e-9


class BlockIndex(NamedTuple):
    """``term, block, most, held`` (a list of ``_id, tf, length``) by part, document frequencies, and the corpus row."""

    blocks: DataFrame
    frequencies: DataFrame
    corpus: DataFrame
    parts: int


def _in_blocks(posted: DataFrame) -> DataFrame:
    """``term, block, most, held`` of postings whose partitions hold whole blocks, one after the other. No shuffle: a task holds a block and a batch at a time."""
    items = ["_id", "tf", "length"]
    fields = [posted.schema[name] for name in items]
    schema = T.StructType([posted.schema["term"], posted.schema["block"], posted.schema["most"]]).add("held", T.ArrayType(T.StructType(fields)))

    def lists(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.sort_by([("block", "ascending"), ("term", "ascending")]).combine_chunks()
        runs = rows.group_by(["block", "term"], use_threads=False).aggregate([("most", "max"), ("tf", "count")]).sort_by([("block", "ascending"), ("term", "ascending")])
        offsets = np.concatenate([[0], np.cumsum(runs.column("tf_count").to_numpy())]).astype(np.int32)
        values = [rows.column(name).combine_chunks() for name in items]
        held = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(values, names=items))
        parts = [runs.column(name).combine_chunks() for name in ("term", "block", "most_max")]
        return pa.RecordBatch.from_arrays([*parts, held], names=["term", "block", "most", "held"])

    def gather(batches):
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            # the last block may go on in the next batch
            last = rows.column("block")[-1]
            whole = pc.not_equal(rows.column("block"), last)
            kept, rows = rows.filter(pc.invert(whole)), rows.filter(whole)
            if rows.num_rows:
                yield lists(rows)
        if kept is not None and kept.num_rows:
            yield lists(kept)

    return posted.mapInArrow(gather, schema)


def write_blocks(df: DataFrame, path: str, parts: int = PARTS, bits: int = BLOCK_BITS) -> None:
    """Keep the postings of ``df`` in blocks. A part is cut into files of similar size, so a term of most documents is no single task."""
    spark = df.sparkSession
    corpus(df).withColumn("parts", F.lit(parts)).write.parquet(f"{path}/corpus")
    average = spark.read.parquet(f"{path}/corpus").first()["average"] or 1.0
    sized = df.filter(F.col(DOCUMENT).isNotNull()).select(ID, DOCUMENT, F.size(tokens(F.col(DOCUMENT))).alias("_size"))
    # documents of one length together have close weights; a partition's rows are numbered as they are sorted
    ordered = sized.repartitionByRange("_size", ID).sortWithinPartitions("_size", ID)
    numbered = ordered.withColumn("block", F.shiftright(F.monotonically_increasing_id(), bits))
    posted = postings(numbered, keep=("block",))
    weight = _weight(F.lit(1.0), F.col("tf"), F.col("length"), F.lit(float(average)))
    rows = _in_blocks(posted.select("term", "block", weight.alias("most"), ID, "tf", "length"))
    placed = rows.withColumn("part", _part(F.col("term"), parts))
    placed.hint("rebalance", "part").sortWithinPartitions("part", "term", "block").write.partitionBy("part").parquet(f"{path}/blocks")
    stored = spark.read.parquet(f"{path}/blocks")
    stored.groupBy("term").agg(F.sum(F.size("held")).cast("long").alias("df")).write.parquet(f"{path}/frequencies")


def read_blocks(spark: SparkSession, path: str) -> BlockIndex:
    blocks, frequencies, row = (spark.read.parquet(f"{path}/{name}") for name in ("blocks", "frequencies", "corpus"))
    return BlockIndex(blocks, frequencies, row, row.first()["parts"])


def _asked(index: BlockIndex, terms: list[str]) -> DataFrame:
    """The blocks of some terms with the terms' weights; only their parts are read."""
    stats = index.corpus.select(F.struct("n", "average").alias("stats")).scalar()
    weighted = index.frequencies.filter(F.col("term").isin(terms)).withColumn("stats", stats)
    weighted = weighted.select("term", _idf(F.col("stats.n"), F.col("df")).alias("idf"), F.col("stats.average").alias("average"))
    found = index.blocks.filter(F.col("term").isin(terms) & F.col("part").isin([_part(F.lit(term), index.parts) for term in terms]))
    return join_small(found, weighted, "term", bound=len(terms), salt_by=F.col("block"))


def bounds(index: BlockIndex, where_document) -> DataFrame:
    """``block, bound``: what no score of a block exceeds, for the blocks with any of the terms. The lists are not read."""
    return _asked(index, contained_terms(where_document)).groupBy("block").agg(F.sum(F.col("idf") * F.col("most")).alias("bound"))


def _scored(index: BlockIndex, where_document, chosen: DataFrame, passing: DataFrame | None) -> DataFrame:
    rows = join_small(_asked(index, contained_terms(where_document)), chosen.select("block"), "block")
    rows = rows.select("term", "block", "idf", "average", F.inline("held"))
    weight = _weight(F.col("idf"), F.col("tf"), F.col("length"), F.col("average"))
    scored = rows.groupBy("block", ID).agg(steady(F.sum(weight)).alias("score"), F.collect_set("term").alias("_terms"))
    scored = scored.filter(document_predicate(where_document, F.lit(None).cast("string"), "terms", F.col("_terms")))
    return scored if passing is None else scored.join(passing.select(ID), ID, "left_semi")


def threshold(index: BlockIndex, where_document, k: int, limits: DataFrame, passing: DataFrame | None = None, first: int = FIRST) -> float:
    """The k-th score among the ``first`` blocks with the highest bounds; 0 where they hold fewer matches."""
    best = _scored(index, where_document, limits.orderBy(F.col("bound").desc(), "block").limit(first), passing).orderBy(F.col("score").desc()).limit(k)
    found, least = best.agg(F.count(F.lit(1)), F.min("score")).first()
    return least if found == k else 0.0


def search_blocks(index: BlockIndex, where_document, k: int = 10, passing: DataFrame | None = None) -> DataFrame:
    """``search_index`` with blocks left out: ``_id, score, rank``."""
    if not only_contains(where_document):
        raise ValueError("an index of terms answers $contains only")
    limits = written(bounds(index, where_document))
    reached = limits.filter(F.col("bound") >= threshold(index, where_document, k, limits, passing) * SLACK)
    order = [F.col("score").desc(), F.col(ID)]
    best = _scored(index, where_document, reached, passing).select(ID, "score").orderBy(*order).limit(k)
    return top_per_group(best.withColumn(QUERY_ID, F.lit(0)), QUERY_ID, order, k)


def blocks_read(index: BlockIndex, where_document, k: int = 10) -> DataFrame:
    """One row ``blocks, reached``: the blocks that hold any of the terms, and those that the second job of a search reads."""
    limits = written(bounds(index, where_document))
    least = threshold(index, where_document, k, limits) * SLACK
    return limits.agg(F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("bound") >= least).alias("reached"))
