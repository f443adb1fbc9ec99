"""Near duplicates by SimHash fingerprints in an index over their Gray order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hybridframe.llm.common import documents, join_groups, measured, query, stage

SEED, SHINGLE, DISTANCE = 42, 3, 2
# Fingerprints of a block of the index, until there are MAX_BLOCKS of them, and the upper nodes of a block that all tasks know.
BLOCK, MAX_BLOCKS, UPPER = 1 << 16, 1 << 12, 64
FAN = 8
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of the word shingles, as a signed number: a bit is 1 where over half of the hashes have it."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    size = min(size, len(words))
    digest, total, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - size + 1
    for at in range(0, count, 8192):
        stop = min(count, at + 8192)
        spans = zip(starts[at:stop].tolist(), (ends[at + size - 1 : stop + size - 1] - 1).tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > count, bitorder="little").view(np.int64)[0])


def gray_rank(fp: Column) -> Column:
    """Place of a bit pattern in the Gray order, shifted so that signed numbers sort like unsigned ones."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """A hierarchy over patterns in Gray order. A node's mask has the bits that all below it share.

    A child keeps only the bits that its parent does not have already. Differences found in the
    shared bits add up on the way down, and a whole group is left as soon as they are too many.
    """

    def __init__(self, every: np.ndarray, some: np.ndarray):
        """``every``: bits set in all of a leaf's patterns; ``some``: bits set in any of them."""
        masks, patterns = [~(every ^ some)], [every]
        while len(every) > FAN:
            at = np.arange(0, len(every), FAN)
            every, some = np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(some, at)
            masks.append(~(every ^ some))
            patterns.append(every)
        self.levels = []
        for k, mask in enumerate(masks):
            above = np.repeat(masks[k + 1], FAN)[: len(mask)] if k + 1 < len(masks) else np.uint64(0)
            self.levels.append((mask & ~above, patterns[k]))

    def search(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query's number and a leaf's number that may be, and for exact leaves are, within the distance."""
        top = len(self.levels[-1][0])
        query = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        spent = np.zeros(len(query), np.uint8)
        for level in range(len(self.levels) - 1, -1, -1):
            mask, pattern = self.levels[level]
            spent = spent + np.bitwise_count((queries[query] ^ pattern[node]) & mask[node])
            near = spent <= distance
            query, node, spent = query[near], node[near], spent[near]
            if level:
                below = len(self.levels[level - 1][0])
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                query, spent = np.repeat(query, FAN), np.repeat(spent, FAN)
                real = node < below
                query, node, spent = query[real], node[real], spent[real]
        return query, node


class Forest:
    """Which of n things hang together; pairs are taken in bulk."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.count = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.waiting.append((a, b))
        self.count += len(a)
        if self.count > 1_000_000:
            self.join()

    def join(self) -> np.ndarray:
        if self.waiting:
            a, b = (np.concatenate(x) for x in zip(*self.waiting))
            self.waiting, self.count = [], 0
            while True:
                x, y = self.root[a], self.root[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
                while (self.root != (up := self.root[self.root])).any():
                    self.root = up
        return self.root


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block its own fingerprints (kind 0), then those that are to be looked up in it (kind 1).

    Links are not listed: what is returned for a block is a forest that connects the same fingerprints.
    """
    block, own, index, forest = None, [], None, None

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def built():
        nonlocal own, index, forest
        own = np.concatenate(own)
        index, forest = GrayIndex(own, own), Forest(len(own))
        for at in range(0, len(own), 512):
            q, leaf = index.search(own[at : at + 512], DISTANCE)
            later = leaf > q + at
            forest.add(q[later] + at, leaf[later])

    def finished() -> Iterator[pa.RecordBatch]:
        if block is not None:
            if index is None:
                built()
            root = forest.join()
            child = np.flatnonzero(root != np.arange(len(root)))
            yield edges(own[child], own[root[child]])

    for batch in batches:
        blocks, kinds, fps = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        fps = fps.view(np.uint64)
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
        for part in np.split(np.arange(len(fps)), cuts):
            if not len(part):
                continue
            if blocks[part[0]] != block:
                yield from finished()
                block, own, index, forest = blocks[part[0]], [], None, None
            if kinds[part[0]] == 0:
                own.append(fps[part])
                continue
            if index is None:
                built()
            for at in range(0, len(part), 512):
                queries = fps[part[at : at + 512]]
                q, leaf = index.search(queries, DISTANCE)
                if len(q):
                    first = np.flatnonzero(np.diff(q, prepend=-1))
                    forest.add(np.repeat(leaf[first], np.diff(np.append(first, len(q)))), leaf)
                    yield edges(queries[q[first]], own[leaf[first]])
    yield from finished()


def near_links(nodes: DataFrame) -> DataFrame:
    """Edges ``a b`` that connect all distinct fingerprints ``fp`` of ``nodes`` linked at ``DISTANCE`` bits or less.

    Fingerprints are sorted by Gray rank over range partitions and numbered; consecutive ones make
    a block, of equal sizes whatever the distribution. Each block's upper nodes, at most ``UPPER``, are
    known to all tasks (there are at most ``MAX_BLOCKS`` x ``UPPER``), so a fingerprint is sent only to later blocks
    in which some upper node has at most ``DISTANCE`` differences in its shared bits.
    """
    spark = nodes.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = nodes.select("fp").repartitionByRange(partitions, gray_rank(F.col("fp"))).sortWithinPartitions(gray_rank(F.col("fp")))
    place = F.monotonically_increasing_id()
    ordered = stage(ordered.withColumn("part", F.spark_partition_id()).withColumn("place", place.bitwiseAND(F.lit((1 << 33) - 1))))
    counts = ordered.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = ordered.count()
    size = max(BLOCK, -(-total // MAX_BLOCKS))
    number = F.col("before") + F.col("place")
    numbered = ordered.join(F.broadcast(counts.select("part", before.alias("before"))), "part").select(
        "fp", F.floor(number / size).alias("block"), F.floor(number % size / -(-size // UPPER)).alias("node")
    )
    upper = (
        numbered.groupBy("block", "node")
        .agg(F.bit_and("fp").alias("every"), F.bit_or("fp").alias("some"))
        .orderBy("block", "node")
        .toPandas()
    )
    if not len(upper):
        return spark.createDataFrame([], "a long, b long")
    shared = spark.sparkContext.broadcast(
        (upper["block"].to_numpy(np.int64), upper["every"].to_numpy(np.int64).view(np.uint64), upper["some"].to_numpy(np.int64).view(np.uint64))
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_node, every, some = shared.value
        index = GrayIndex(every, some)
        for batch in batches:
            fps, home = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at in range(0, len(fps), 2048):
                part = fps[at : at + 2048]
                q, node = index.search(part.view(np.uint64), DISTANCE)
                key = np.unique(q * (MAX_BLOCKS + 1) + of_node[node])
                q, block = key // (MAX_BLOCKS + 1), key % (MAX_BLOCKS + 1)
                later = block > home[at : at + 2048][q]
                q, block = q[later], block[later]
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(np.ones(len(q), np.int32)), pa.array(part[q])], ["block", "kind", "fp"])

    routed = numbered.select("fp", "block").mapInArrow(route, "block long, kind int, fp long")
    rows = numbered.select("block", F.lit(0).alias("kind"), "fp").unionByName(routed)
    rows = rows.repartition(partitions, "block").sortWithinPartitions("block", "kind", gray_rank(F.col("fp")))
    return rows.mapInArrow(_links, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``fp label`` for everything that has an edge: the label is the smallest of its component.

    Alternating stars: every vertex hangs its larger neighbours, then its smaller ones, on its smallest.
    Each round is written; the distances to the smallest fall by a constant factor.
    """
    state = F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")
    edges, known = measured(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), *state)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges, now = measured(_star(both, F.col("b") > F.col("a"), 2 * known["n"]), *state)
        edges, now = measured(_star(edges, F.lit(True), now["n"]), *state)
        if now == known:
            break
        known = now
    tops = edges.select(F.col("b").alias("fp"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("fp"), F.col("b").alias("label")).unionByName(tops)


def _star(edges: DataFrame, moved: Column, total: int) -> DataFrame:
    """Each of the ``total`` edges ``a b`` with ``moved`` becomes one from b to the smallest of a and a's neighbours; a hangs there too."""
    least = stage(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"), F.count("*").alias("n")))
    hung = join_groups(edges, least, ["a"], "n", total, 32).filter(moved).select(F.col("b").alias("a"), F.col("least").alias("b"))
    itself = least.select("a", F.col("least").alias("b"))
    return hung.unionByName(itself).filter("a <> b").distinct()


def group_rows(rows: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``row fp component_id kept`` of the rows, from the edges between their nodes (``fp``, ``first`` row, ``n`` rows)."""
    members = stage(components(edges).join(nodes, "fp"))
    labels, sums = measured(members.groupBy("label").agg(F.min("first").alias("lowest"), F.count("*").alias("size")), F.sum("size").alias("total"))
    linked = join_groups(members.select("fp", "label"), labels, ["label"], "size", sums["total"] or 0, 64).select("fp", "lowest")
    table = stage(nodes.join(linked, "fp", "left").select("fp", "n", F.coalesce("lowest", "first").alias("lowest")))
    found = join_groups(rows, table, ["fp"], "n", nodes.agg(F.sum("n")).first()[0] or 0, 64)
    return found.select("row", "fp", F.col("lowest.id").alias("component_id"), (F.col("lowest.rid") == F.col("rid")).alias("kept"))


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry=()) -> DataFrame:
    """``row`` (id and ``carry``), ``fp``, ``component_id`` and ``kept`` for every row of ``df``.

    Lower-cased (A-Z) words in shingles of three give a fingerprint of 64 bits; fingerprints link at two differing bits or
    fewer, and a component is all that links reach. ``component_id`` is its smallest id, and that row is kept; null ids come
    last, and of rows that repeat an id one is kept. Null, empty and blank texts have fingerprint 0, which links
    like any other. Copies meet as one fingerprint before anything is compared. An empty table gives an empty result.
    """
    hashed = F.pandas_udf(lambda texts: texts.map(fingerprint).astype("int64"), "long")
    rows = df.select(F.struct(F.col(id_col).alias("id"), *carry).alias("row"), F.col(id_col).alias("id"), hashed(F.col(text_col)).alias("fp"))
    rows = stage(rows.withColumn("rid", F.monotonically_increasing_id()))
    first = F.struct(F.col("id").isNull().alias("none"), "id", "rid")
    nodes = stage(rows.groupBy("fp").agg(F.min(first).alias("first"), F.count("*").alias("n")))
    return group_rows(rows, nodes, near_links(nodes))


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(documents(spark, sf_dir, "doc_id", "text"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("row.id").alias("doc_id"), hexed.alias("fingerprint"), "component_id")
