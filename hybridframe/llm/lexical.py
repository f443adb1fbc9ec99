"""Ranked lexical search for many items at once: documents as paths of a frequency-ordered tree, searched depth first with bounds."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hybridframe.llm.common import documents, query, stage

K = 10
# Items are searched in blocks of at most this many bytes of text (or one item), so what is broadcast is bounded.
BLOCK_BYTES = 8 << 20
# A tree holds the documents of about this many entries (term and count); a leaf this many documents.
ENTRIES, LEAF = 1 << 20, 24
# Places of a path that documents are dealt by.
DEALT = 8
# A text is cut into terms in pieces of about this many bytes.
PIECE = 1 << 20
TF_SCALE, TF_PART, LENGTH_PART, LENGTH_BASE, LENGTH_SHARE, WEIGHT = 1_000_000_000, 1000, 8, 100, 75, 1000

# Terms are runs of ASCII letters and digits and of everything that is not ASCII; the rest becomes blank, A-Z small.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(TERMS)
    start = 0
    while start < len(data):
        end = len(data) if len(data) - start <= PIECE else data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def search(
    docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every row of ``items``, of all documents and their whole texts.

    A document is restricted to the items' terms, in the order of their document frequency; documents with a common beginning share a
    path of a tree. A node knows for every term of its documents the largest count, and their smallest length: what a
    document with both would score is a bound for all of them, as a score rises with counts and falls with length. Each item goes
    down depth first, best child first, and leaves out a subtree whose bound is below its ``k``-th score so far.

    Documents are range-partitioned by their path, so that shared paths lie in one task however many have them; equal paths are split by
    length and id. A task builds its trees over parts of bounded size, one after the other, and sends ``k`` rows an item. Items go in blocks of
    bounded size, each with a pass over the documents.

    Equal scores go by ascending id, null ids last. Null texts and texts without terms are never found; items without (known)
    terms get no rows. Every row is a document and every row of ``items`` an item of its own, also with a repeated id. Ids of documents are whole
    numbers. Very long texts are cut into terms piece by piece. Empty tables give an empty result.
    """
    wanted = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).filter("text is not null")
    results = [_search_block(docs, block, k, id_col, text_col, wanted.schema["item_id"]) for block in _blocks(stage(wanted))]
    found = results[0]
    for part in results[1:]:
        found = found.unionByName(part)
    return found


def _blocks(items: DataFrame, parts: int = 1, number: int = 0) -> Iterator[list]:
    """The items, ``(id, text)``, in lists of bounded size: halved by a hash until they are small enough or cannot be divided."""
    own = items if parts == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == number)
    size, count = own.agg(F.sum(F.octet_length("text") + 64), F.count_distinct("item_id", "text")).first()
    if (size or 0) <= BLOCK_BYTES or count <= 1:
        if count or parts == 1:
            yield [tuple(row) for row in own.collect()]
        return
    yield from _blocks(items, parts * 2, number)
    yield from _blocks(items, parts * 2, number + parts)


def _search_block(docs: DataFrame, block: list, k: int, id_col: str, text_col: str, id_field) -> DataFrame:
    spark = docs.sparkSession
    counts = [sum((Counter(part) for part in terms(text)), Counter()) for _, text in block]
    names = sorted(set().union(*counts))
    vectors = stage(_restricted(docs, {name: i for i, name in enumerate(names)}, id_col, text_col))
    n_docs, length = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    held = {row["term"]: row["df"] for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    order = sorted(held, key=lambda term: (-held[term], term))
    place = np.full(len(names) + 1, -1, np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    weights = np.array([math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) for t in order], np.int64)
    number = {name: i for i, name in enumerate(names)}
    queries = []
    for own in counts:
        at = sorted((int(place[number[name]]), times) for name, times in own.items() if place[number[name]] >= 0)
        queries.append((np.array([p for p, _ in at], np.int64), np.array([weights[p] * times for p, times in at], np.int64)))
    shared = spark.sparkContext.broadcast((queries, len(order)))
    short = F.lit(LENGTH_BASE - LENGTH_SHARE) + F.expr(f"({LENGTH_SHARE} * n * {n_docs or 0}L) div {length or 1}L")
    paths = _ordered(vectors.filter(F.size("terms") > 0).withColumn("m", short), place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, width = shared.value
        best: list[list] = [[] for _ in queries]
        for ids, m, sizes, ranks, tfs in _parts(batches):
            tree = Tree(ids, m, sizes, ranks, tfs)
            line = np.zeros(width, np.int64)
            for (at, own), top in zip(queries, best):
                if len(at):
                    line[at] = own
                    tree.search(line, top, k)
                    line[at] = 0
        for item, top in enumerate(best):
            if top:
                ids = [None if -i >= NO_ID else -i for _, i in top]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(top), pa.int32()), pa.array(ids, pa.int64()), pa.array([s for s, _ in top], pa.int64())], ["item", "doc_id", "score"])

    hits = paths.mapInArrow(run, "item int, doc_id long, score long")
    ranking = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    hits = hits.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= k)
    ids = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item int, item_id {id_field.dataType.simpleString()}")
    return hits.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def _restricted(docs: DataFrame, numbers: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``doc_id n terms tfs``: a document's number of terms, and those of the items among them with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, ends, found, tfs = [], [0], [], []
            for text in batch.column(1):  # one by one: a batch of long texts is not copied as a whole
                own, n = Counter(), 0
                for part in terms(text.as_py()):
                    n += len(part)
                    own.update(map(known.get, part))
                own.pop(None, None)
                sizes.append(n)
                found.extend(own.keys())
                tfs.extend(own.values())
                ends.append(len(found))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(values, kind)) for values, kind in ((found, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>")


def _ordered(vectors: DataFrame, place: np.ndarray) -> DataFrame:
    """``doc_id m path tfs``: terms as places in the order of frequency, rising; sorted by path over range partitions."""
    shared = vectors.sparkSession.sparkContext.broadcast(place)

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, tfs = batch.column(2), batch.column(3)
            sizes = np.diff(lists.offsets.to_numpy())
            ranks, values = shared.value[lists.flatten().to_numpy(zero_copy_only=False)], tfs.flatten().to_numpy(zero_copy_only=False)
            by = np.lexsort((ranks, np.repeat(np.arange(len(sizes)), sizes)))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            arrays = [pa.ListArray.from_arrays(offsets, pa.array(x[by])) for x in (ranks, values)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["doc_id", "m", "path", "tfs"])

    rows = vectors.select("doc_id", "m", "terms", "tfs").mapInArrow(arrange, "doc_id long, m long, path array<int>, tfs array<long>")
    # the first places are enough to deal by; what Spark samples for the ranges stays small
    return rows.repartitionByRange(F.slice("path", 1, DEALT), "m", "doc_id").sortWithinPartitions("path", "m", "doc_id")


NO_ID = 1 << 63


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The sorted rows in parts of about ``ENTRIES`` entries: ids, lengths, sizes of the paths, places and counts."""
    held, entries = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            entries += len(batch.column(2).flatten())
        if entries >= ENTRIES:
            yield _joined(held)
            held, entries = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple:
    ids = [NO_ID if i is None else i for batch in held for i in batch.column(0).to_pylist()]
    whole = lambda parts: np.concatenate([x.to_numpy(zero_copy_only=False) for x in parts]).astype(np.int64)
    sizes = np.concatenate([np.diff(b.column(2).offsets.to_numpy()) for b in held]).astype(np.int64)
    return ids, whole(b.column(1) for b in held), sizes, whole(b.column(2).flatten() for b in held), whole(b.column(3).flatten() for b in held)


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The part of a term's weight that counts."""
    return (TF_SCALE * tf) // (TF_PART * tf + LENGTH_PART * m)


class Tree:
    """Sorted paths as a tree: a node is a stretch of documents with a common beginning, divided by what comes next."""

    def __init__(self, ids: list, m: np.ndarray, sizes: np.ndarray, ranks: np.ndarray, tfs: np.ndarray):
        self.ids, self.m, self.sizes, self.ranks, self.tfs = ids, m, sizes, ranks, tfs
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.scores = saturated(tfs, np.repeat(m, sizes))
        self.children: dict[int, list[int]] = {}
        self.stretch: list[tuple[int, int]] = []
        self.places: list[np.ndarray] = []
        self.bounds: list[np.ndarray] = []
        self.least: list[int] = []
        self._grow()

    def _cuts(self, a: int, b: int, depth: int) -> tuple[np.ndarray, int]:
        """Where the stretch divides: at the first place where its first and last paths differ. Equal paths are cut in the middle."""
        one, other = self.starts[a], self.starts[b - 1]
        most = int(min(self.sizes[a], self.sizes[b - 1]))
        differ = np.flatnonzero(self.ranks[one + depth : one + most] != self.ranks[other + depth : other + most])
        depth = depth + int(differ[0]) if len(differ) else most
        rows = np.arange(a, b)
        ended = self.sizes[a:b] <= depth
        at = np.where(ended, -1, self.ranks[np.minimum(self.starts[rows] + depth, len(self.ranks) - 1)])
        cuts = np.flatnonzero(np.diff(at)) + a + 1
        return (cuts if len(cuts) else np.array([(a + b) // 2])), depth

    def _grow(self) -> None:
        """Divide from the root down; gather counts and lengths from the leaves up."""
        order, open_ = [], [(0, len(self.sizes), 0, -1)]
        while open_:
            a, b, depth, parent = open_.pop()
            node = len(self.stretch)
            self.stretch.append((a, b))
            order.append((node, parent))
            if parent >= 0:
                self.children.setdefault(parent, []).append(node)
            if b - a > LEAF:
                cuts, depth = self._cuts(a, b, depth)
                # neighbours that are smaller than a leaf together are one child
                begin, edges = a, []
                for cut in [*cuts.tolist(), b]:
                    if cut - begin > LEAF and edges and edges[-1] > begin:
                        begin = edges[-1]
                        edges.append(cut)
                    elif edges and edges[-1] > begin:
                        edges[-1] = cut
                    else:
                        edges.append(cut)
                begin = a
                for cut in edges:
                    open_.append((begin, cut, depth, node))
                    begin = cut
        count = len(self.stretch)
        merged: list = [None] * count
        self.places, self.bounds, self.least = [None] * count, [None] * count, [0] * count
        for node, _ in reversed(order):
            if node in self.children:
                parts = [merged[child] for child in self.children[node]]
                ranks, tfs = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                m, least = min(p[2] for p in parts), min(p[3] for p in parts)
                for child in self.children[node]:
                    merged[child] = None
            else:
                a, b = self.stretch[node]
                span = slice(self.starts[a], self.starts[b])
                ranks, tfs, m, least = self.ranks[span], self.tfs[span], int(self.m[a:b].min()), min(self.ids[a:b])
            by = np.argsort(ranks, kind="stable")
            ranks = ranks[by]
            first = np.flatnonzero(np.diff(ranks, prepend=-1))
            ranks, tfs = ranks[first], np.maximum.reduceat(tfs[by], first)
            merged[node] = ranks, tfs, m, least
            self.places[node], self.bounds[node], self.least[node] = ranks, saturated(tfs, m), least

    def search(self, line: np.ndarray, top: list, k: int) -> None:
        """Put the best documents in the heap ``top`` of ``(score, -id)``; ``line`` has the item's weight for every place."""
        bound = lambda node: int(line[self.places[node]] @ self.bounds[node])
        out = lambda most, least: most <= 0 or (len(top) == k and (most, -least) <= top[0])
        open_ = [(bound(0), 0)]
        while open_:
            most, node = open_.pop()
            if out(most, self.least[node]):
                continue
            if node in self.children:
                # the best child is popped first
                open_.extend(sorted(pair for child in self.children[node] if not out((pair := (bound(child), child))[0], self.least[child])))
                continue
            a, b = self.stretch[node]
            span = slice(self.starts[a], self.starts[b])
            scores = np.add.reduceat(line[self.ranks[span]] * self.scores[span], self.starts[a:b] - self.starts[a])
            for row in np.flatnonzero(scores >= max(1, top[0][0] if len(top) == k else 1)):
                found = int(scores[row]), -self.ids[a + row]
                if len(top) < k:
                    heapq.heappush(top, found)
                elif found > top[0]:
                    heapq.heapreplace(top, found)


@query(
    "op11_lexical_search",
    r"""
    WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
    d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM c GROUP BY doc_id),
    s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM d),
    m AS (SELECT doc_id, 100 - 75 + ((75 * n * docs) // total) AS m FROM d, s),
    q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    i AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY item_id, term),
    f AS (SELECT term, count(*)::BIGINT AS df FROM c WHERE term IN (SELECT term FROM i) GROUP BY term),
    w AS (SELECT term, floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE)))::BIGINT AS w FROM f, s),
    r AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
          FROM i JOIN w USING (term) JOIN c USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM r WHERE score > 0 QUALIFY rank <= 10""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return search(documents(spark, sf_dir, "doc_id", "text"), items)
