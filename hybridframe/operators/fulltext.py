"""Ranked full-text search (BM25).

One text is scored row by row: the term frequencies of a document are an expression over that row,
so nothing is shuffled but the k best. The terms of many texts are a DataFrame that postings are joined with; what matches meets
the queries in tiles of documents and queries. A stored index holds postings, of which a search reads those of its terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hybridframe.functions.columns import steady
from hybridframe.functions.predicates import contained_terms, only_contains, selection, where_document as document_predicate
from hybridframe.functions.text import BREAK, term_frequency, tokens
from hybridframe.operators.joins import is_small, join_small, top_per_group
from hybridframe.operators.nearest import QUERY_ID, TopLists, arrow_type, attach
from hybridframe.operators.retrieve import project, select_records
from hybridframe.plans.session import written
from hybridframe.schema import DOCUMENT, ID

# The usual constants of the published formula.
K1 = 1.2
B = 0.75

# Folders of a stored index.
PARTS = 64

# Queries and matching postings of a tile, and (document, term, query) triples that are held at a time.
QUERY_BLOCK = 256
TILE_POSTINGS = 1 << 19
MAX_TRIPLES = 4_000_000
# Postings of an Arrow batch, but for those of its last document.
COUNTED_TERMS = 1 << 16


def _idf(n: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))


def _weight(idf: Column, tf: Column, length: Column, average: Column) -> Column:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average))


def postings(df: DataFrame, document: str = DOCUMENT, keep: tuple[str, ...] = ()) -> DataFrame:
    """``term, _id, tf, length``: one row per distinct term of a document. No shuffle.

    Spark cuts the texts as ``tokens`` does, the terms of one document are counted in Arrow batches.
    """
    carried = [df.schema[c] for c in (ID, *keep)]
    schema = T.StructType([T.StructField("term", T.StringType()), *[T.StructField(c.name, c.dataType) for c in carried]])
    schema = schema.add("tf", T.IntegerType()).add("length", T.IntegerType())
    names = schema.fieldNames()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, terms, counts, lengths = [], [], [], []

            def counted() -> pa.RecordBatch:
                at = np.repeat(rows, [len(x) for x in counts])
                others = [batch.column(i).take(pa.array(at)) for i in range(1, batch.num_columns)]
                tf = np.fromiter(chain.from_iterable(counts), np.int32, len(at))
                columns = [pa.array(terms, pa.string()), *others, pa.array(tf), pa.array(np.asarray(lengths, np.int32)[at - rows[0]])]
                return pa.RecordBatch.from_arrays(columns, names)

            for row, text in enumerate(batch.column(0)):
                found = Counter(text.as_py().split(" "))
                found.pop("", None)
                rows.append(row)
                terms += found.keys()
                counts.append(found.values())
                lengths.append(sum(found.values()))
                if len(terms) >= COUNTED_TERMS:
                    yield counted()
                    rows, terms, counts, lengths = [], [], [], []
            if terms:
                yield counted()

    # a break is one blank and no term holds one
    spaced = df.filter(F.col(document).isNotNull()).select(F.regexp_replace(F.lower(document), BREAK, " ").alias("_spaced"), ID, *keep)
    return spaced.mapInArrow(count, schema).select("term", ID, *keep, "tf", "length")


def document_frequencies(posted: DataFrame) -> DataFrame:
    return posted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus(df: DataFrame, document: str = DOCUMENT) -> DataFrame:
    """One row ``n, average``: documents with a text, and their mean length in terms."""
    return df.filter(F.col(document).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.size(tokens(F.col(document)))).alias("average")
    )


def _part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def write_index(df: DataFrame, path: str, parts: int = PARTS) -> None:
    """Keep the postings for many searches, laid out so that a search reads the parts of its terms.

    A part is cut into files of similar size, so a term held by most documents is no single task.
    """
    placed = postings(df).withColumn("part", _part(F.col("term"), parts))
    placed.hint("rebalance", "part").sortWithinPartitions("part", "term").write.partitionBy("part").parquet(f"{path}/postings")
    stored = df.sparkSession.read.parquet(f"{path}/postings")
    # lengths add up to the terms that the postings count, so no text is cut a second time
    texts = df.filter(F.col(DOCUMENT).isNotNull()).agg(F.count(F.lit(1)).alias("n"))
    total = stored.agg(F.coalesce(F.sum("tf"), F.lit(0)).cast("double").alias("length"))
    row = texts.crossJoin(total).select("n", F.try_divide("length", F.col("n")).alias("average"))
    row.withColumn("parts", F.lit(parts)).write.parquet(f"{path}/corpus")
    document_frequencies(stored).write.parquet(f"{path}/frequencies")


class TextIndex(NamedTuple):
    """Postings, document frequencies and the corpus row; ``parts`` is set for a stored index."""

    postings: DataFrame
    frequencies: DataFrame
    corpus: DataFrame
    parts: int | None = None


def build_index(df: DataFrame) -> TextIndex:
    """The index of a frame, computed when it is used."""
    posted = postings(df)
    return TextIndex(posted, document_frequencies(posted), corpus(df))


def read_index(spark: SparkSession, path: str) -> TextIndex:
    posted, frequencies, row = (spark.read.parquet(f"{path}/{name}") for name in ("postings", "frequencies", "corpus"))
    return TextIndex(posted, frequencies, row, row.first()["parts"])


def postings_of(index: TextIndex, terms: list[str]) -> DataFrame:
    """Postings of some terms. Of a stored index only the parts of these terms are read."""
    posted = index.postings.filter(F.col("term").isin(terms))
    if index.parts is not None and terms:
        # The parts fold to constants, which prunes the partitions.
        posted = posted.filter(F.col("part").isin([_part(F.lit(term), index.parts) for term in terms]))
    return posted


def search_index(index: TextIndex, where_document, k: int = 10, passing: DataFrame | None = None) -> DataFrame:
    """``search_text`` from an index: ``_id, score, rank``, the texts are not read.

    ``passing`` holds the ids that a metadata filter admits. Only ``$contains`` can be answered; anything else raises.
    """
    if not only_contains(where_document):
        raise ValueError("an index of terms answers $contains only")
    terms = contained_terms(where_document)
    stats = index.corpus.select(F.struct("n", "average").alias("stats"))
    weighted = (
        index.frequencies.filter(F.col("term").isin(terms))
        .withColumn("stats", stats.scalar())
        .select("term", _idf(F.col("stats.n"), F.col("df")).alias("idf"), F.col("stats.average").alias("average"))
    )
    # One row per query term, so this side is as small as the query.
    matched = join_small(postings_of(index, terms), weighted, "term", bound=len(terms), salt_by=F.col(ID))
    weight = _weight(F.col("idf"), F.col("tf"), F.col("length"), F.col("average"))
    scored = matched.groupBy(ID).agg(steady(F.sum(weight)).alias("score"), F.collect_set("term").alias("_terms"))
    scored = scored.filter(document_predicate(where_document, F.lit(None).cast("string"), "terms", F.col("_terms")))
    if passing is not None:
        scored = scored.join(passing.select(ID), ID, "left_semi")
    order = [F.col("score").desc(), F.col(ID)]
    best = scored.select(ID, "score").orderBy(*order).limit(k)
    return top_per_group(best.withColumn(QUERY_ID, F.lit(0)), QUERY_ID, order, k)


def search_text(
    df: DataFrame,
    where_document,
    k: int = 10,
    where=None,
    include=None,
    statistics: DataFrame | None = None,
    mode: str = "terms",
    **options,
) -> DataFrame:
    """``_id, score, rank`` of the k best documents for one text filter.

    A document must pass the filter; its score counts every term that a ``$contains`` mentions.
    Frequencies are those of the whole frame, so a metadata filter changes which documents are
    listed and not how they score. A filter without terms (``$regex`` alone) scores 1.
    """
    terms = contained_terms(where_document)
    passing = select_records(df, None, where, None, **options)
    if terms:
        stats = _text_statistics(df, terms) if statistics is None else statistics
        # Each step is a projection that is read several times, which keeps Spark from computing it
        # several times. No filter comes before the top k: it would cut every text a second time.
        counted = passing.withColumn("_terms", tokens(F.col(DOCUMENT))).withColumn("_length", F.size("_terms"))
        counted = counted.withColumn("_tf", F.array(*[term_frequency(F.col("_terms"), term) for term in terms]))
        counted = counted.withColumn("_stats", stats.scalar())
        mentioned = F.filter(F.array(*[F.lit(term) for term in terms]), lambda _, i: F.get("_tf", i) > 0)
        matches = document_predicate(where_document, F.col(DOCUMENT), mode, mentioned)
        score = steady(_score(F.col("_tf"), F.col("_length"), F.col("_stats"), len(terms)))
        scored = counted.withColumn("score", F.when(matches, score))
    else:
        scored = passing.filter(document_predicate(where_document, F.col(DOCUMENT), mode)).withColumn("score", F.lit(1.0))
    order = [F.col("score").desc_nulls_last(), F.col(ID)]
    best = project(scored, include, ("score",)).orderBy(*order).limit(k).filter("score is not null")
    return top_per_group(best.withColumn(QUERY_ID, F.lit(0)), QUERY_ID, order, k)


def _score(tf: Column, length: Column, stats: Column, terms: int) -> Column:
    weights = [
        _weight(_idf(stats["n"], F.get(stats["df"], F.lit(i))), F.get(tf, F.lit(i)), length, stats["average"]) for i in range(terms)
    ]
    return reduce(add, weights)


def _text_statistics(df: DataFrame, terms: list[str]) -> DataFrame:
    """One struct ``n, average, df[i]`` from one pass over the texts."""
    counted = df.filter(F.col(DOCUMENT).isNotNull()).select(tokens(F.col(DOCUMENT)).alias("terms"))
    has = [F.count_if(F.array_contains("terms", term)) for term in terms]
    row = counted.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.size("terms")).alias("average"), F.array(*has).alias("df")
    )
    return row.select(F.struct("n", "average", "df").alias("stats"))


def query_terms(queries: DataFrame, text: str = "text") -> DataFrame:
    """``query_id, term``: the distinct terms of every query."""
    return queries.select(QUERY_ID, F.explode(F.array_distinct(tokens(F.col(text)))).alias("term"))


class TermBlock:
    """Some queries as, for every term number, the positions of the queries that ask for it."""

    def __init__(self, rows: list):
        self.ids = list(dict.fromkeys(row[QUERY_ID] for row in rows))
        position = {ident: i for i, ident in enumerate(self.ids)}
        self.terms = sorted({row["term"] for row in rows})
        number = {term: i for i, term in enumerate(self.terms)}
        pairs = sorted((number[row["term"]], position[row[QUERY_ID]]) for row in rows)
        self.askers = np.asarray([q for _, q in pairs], dtype=np.int64)
        self.starts = np.searchsorted([t for t, _ in pairs], np.arange(len(self.terms) + 1))


class ScoreLists(TopLists):
    """The best documents of Arrow batches ``_id, number, weight``, the rows of a document together."""

    def __init__(self, block: TermBlock, k: int):
        super().__init__(len(block.ids), k)
        self.block = block

    def add(self, table: pa.Table) -> None:
        """Take in whole documents, a few million (document, term, query) triples at a time."""
        ids = table.column(0).combine_chunks()
        numbers, weights = table.column(1).to_numpy(), table.column(2).to_numpy()
        begins = np.concatenate([[0], np.flatnonzero(_changes(ids)) + 1])
        asked = self.block.starts[numbers + 1] - self.block.starts[numbers]
        triples = np.add.reduceat(asked, begins).cumsum()
        cuts = np.searchsorted(triples, np.arange(MAX_TRIPLES, triples[-1], MAX_TRIPLES))
        for documents in np.split(np.arange(len(begins)), np.unique(cuts)):
            if len(documents):
                first = begins[documents[0]]
                last = begins[documents[-1] + 1] if documents[-1] + 1 < len(begins) else len(numbers)
                self._score(ids, begins[documents], numbers[first:last], weights[first:last], asked[first:last], first)

    def _score(self, ids, begins, numbers, weights, asked, first) -> None:
        queries = len(self.block.ids)
        document = np.zeros(len(numbers), dtype=np.int64)
        document[begins[1:] - first] = 1
        document = document.cumsum()
        offset = np.arange(asked.sum()) - np.repeat(asked.cumsum() - asked, asked)
        asker = self.block.askers[np.repeat(self.block.starts[numbers], asked) + offset]
        cell = np.repeat(document, asked) * queries + asker
        scores = np.bincount(cell, np.repeat(weights, asked), len(begins) * queries).reshape(-1, queries)
        # A document without any of a query's terms has nothing added up; weights are above 0.
        scores = steady(scores)
        possible = (scores > 0) & (-scores <= self.limits)
        for q in np.flatnonzero(possible.any(axis=0)):
            rows = np.flatnonzero(possible[:, q])
            if len(rows) > self.k:
                worst = np.partition(scores[rows, q], -self.k)[-self.k]
                rows = rows[scores[rows, q] >= worst]
            names = np.asarray(ids.take(pa.array(begins[rows])).to_pylist(), dtype=object)
            self.offer(q, names, -scores[rows, q])


def _changes(ids: pa.Array) -> np.ndarray:
    """Where the next id is another one."""
    return pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)


def _weights(asked: DataFrame, frequencies: DataFrame, corpus_row: DataFrame) -> DataFrame:
    """``term, df, idf, average`` of the terms that are asked for."""
    stats = corpus_row.select(F.struct("n", "average").alias("stats"))
    known = join_small(frequencies, asked.select("term").distinct(), "term").withColumn("stats", stats.scalar())
    return known.select("term", "df", _idf(F.col("stats.n"), F.col("df")).alias("idf"), F.col("stats.average").alias("average"))


def score_tiles(matched: DataFrame, asked: DataFrame, queries: int, postings_: int, k: int, id_type: T.DataType) -> DataFrame:
    """``query_id, rank, _id, score`` from the matching postings (``_id, term, weight``) and ``asked`` (``query_id, term``).

    Documents are dealt into parts and queries into blocks, by hashes. A posting goes to the blocks that ask for its term, so that a tile can add up
    whole scores; it is sent once for each block and not for each query. No (document, query) pair is shuffled, only the k best per tile and query.
    """
    parts, blocks = max(1, -(-postings_ // TILE_POSTINGS)), max(1, -(-queries // QUERY_BLOCK))
    dealt = lambda name, number: F.pmod(F.xxhash64(name), F.lit(number)).cast("int")
    asked = asked.withColumn("block", dealt(QUERY_ID, blocks))
    left = join_small(matched, asked.select("term", "block").distinct(), "term", salt_by=F.col(ID)).withColumn("tile", dealt(ID, parts))
    right = asked.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    schema = T.StructType([T.StructField(QUERY_ID, id_type)]).add(ID, "string").add("score", "double")
    arrow_id = arrow_type(id_type)

    def search(own: pa.Table, wanted: pa.Table) -> pa.Table:
        empty = pa.Table.from_arrays([pa.array([], arrow_id), pa.array([], pa.string()), pa.array([], pa.float64())], schema.fieldNames())
        if not own.num_rows or not wanted.num_rows:
            return empty
        block = TermBlock(wanted.select([QUERY_ID, "term"]).to_pylist())
        own = own.sort_by(ID)
        numbers = pc.index_in(own.column("term"), pa.array(block.terms, pa.string()))
        lists = ScoreLists(block, k)
        lists.add(pa.table([own.column(ID), numbers.cast(pa.int64()), own.column("weight")], names=[ID, "number", "weight"]))
        return pa.Table.from_batches([*empty.to_batches(), *lists.batches(block.ids, arrow_id, schema.fieldNames(), -1.0)], empty.schema)

    keys = ["block", "tile"]
    # a column of its own, as both sides have the block from one table
    left = left.select((F.col("block") + 0).alias("block"), "tile", ID, "term", "weight")
    right = right.select(*keys, QUERY_ID, "term")
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)
    return top_per_group(hits, QUERY_ID, [F.col("score").desc(), F.col(ID)], k)


def search_index_batch(index: TextIndex, queries: DataFrame, k: int = 10, passing: DataFrame | None = None) -> DataFrame:
    """BM25 from an index for every row of ``queries`` (``query_id, text``): ``query_id, rank, _id, score``.

    ``passing`` holds the ids that a metadata filter admits. Terms and their weights are joined with the postings on (part, term); the parts that no term lies in are not read.
    """
    asked = written(query_terms(queries))
    weights = written(_weights(asked, index.frequencies, index.corpus))
    total, found = asked.select(F.count_distinct(QUERY_ID)).first()[0], weights.agg(F.sum("df")).first()[0] or 0
    posted, wanted = index.postings, weights.filter("df > 0").drop("df")
    if index.parts is not None:
        # joined on both; with the filter on the small side Spark prunes the parts when it runs
        wanted = wanted.withColumn("part", _part(F.col("term"), index.parts))
        posted = posted.withColumnRenamed("term", "_term")
        small = F.broadcast(wanted) if is_small(wanted) else wanted
        posted = posted.join(small, (posted["part"] == small["part"]) & (posted["_term"] == small["term"])).select(small["*"], ID, "tf", "length")
    else:
        posted = join_small(posted, wanted, "term", salt_by=F.col(ID))
    if passing is not None:
        posted = posted.join(passing.select(ID), ID, "left_semi")
    weight = _weight(F.col("idf"), F.col("tf"), F.col("length"), F.col("average"))
    return score_tiles(posted.select(ID, "term", weight.alias("weight")), asked, total, found, k, queries.schema[QUERY_ID].dataType)


def search_text_batch(df: DataFrame, queries: DataFrame, k: int = 10, where=None, include=None, **options) -> DataFrame:
    """BM25 for every row of ``queries`` (``query_id, text``), over any of its terms.

    Texts are cut into terms once for their postings, of which those asked for are kept, and once for the corpus' length.
    """
    if where:
        posted = postings(df.withColumn("passes", F.coalesce(selection(where, **options), F.lit(False))), keep=("passes",))
    else:
        posted = postings(df).withColumn("passes", F.lit(True))
    asked = written(query_terms(queries))
    matched = written(join_small(posted, asked.select("term").distinct(), "term", salt_by=F.col(ID)))
    weights = written(_weights(asked, document_frequencies(matched), corpus(df)))
    total, found = asked.select(F.count_distinct(QUERY_ID)).first()[0], weights.agg(F.sum("df")).first()[0] or 0
    passing = join_small(matched.filter("passes"), weights.drop("df"), "term", salt_by=F.col(ID))
    weight = _weight(F.col("idf"), F.col("tf"), F.col("length"), F.col("average"))
    hits = score_tiles(passing.select(ID, "term", weight.alias("weight")), asked, total, found, k, queries.schema[QUERY_ID].dataType)
    return attach(hits, df, include, bound=k * total)
