"""Removal of repeated strings by suffix buckets that a difference cover keeps small."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridframe.llm.common import documents, query, stage, text_or_empty

LENGTH = 200
# A perfect difference set modulo 133 (every distance is the difference of one pair).
PERIOD = 133
COVER = (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121)
# Two equal strings of LENGTH bytes have a common sampled offset below PERIOD, so this much of them follows it.
SAMPLE = LENGTH - PERIOD + 1
# Bytes of text that a task hashes at a time, and bytes of a suffix bucket that it aims to sort at a time.
SLICE, BUCKET = 1 << 20, 8 << 20
# The last sort takes its buckets in so many rounds, each written before the next, to hold only a part of the suffixes on disk.
ROUNDS = 3
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
# An entry of a bucket: 48 bits of its string's hash besides those that choose the bucket, more bits where equality is
# decided, document, position, and whether several entries are one. Written column by column.
FIELDS = {"low": "<u4", "high": "<u2", "more": None, "doc": "<i8", "pos": "<u4", "many": "u1"}
PROPOSES, DECIDES, SURROUNDINGS = None, "<u4", "<u8"
Columns = dict[str, np.ndarray]


@functools.lru_cache(8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    out = []
    for number in (base, pow(base, -1, 1 << 64)):
        steps = np.full(size, number, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


class Hashes:
    """Hashes of any substrings of a byte array, from running sums."""

    def __init__(self, data: np.ndarray, base: int):
        size = 1 << max(10, int(len(data)).bit_length())
        power, self.inverse = _powers(base, size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=self.sums[1:])

    def of(self, at: np.ndarray, length: int) -> np.ndarray:
        value = (self.sums[at + length] - self.sums[at]) * self.inverse[at]
        value ^= value >> np.uint64(31)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return value ^ (value >> np.uint64(29))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Rows in groups of about ``SLICE`` bytes of text."""
    for batch in batches:
        frame = batch.to_pandas()
        size = frame["text"].map(len).to_numpy().cumsum() // SLICE
        for _, part in frame.groupby(size, sort=False):
            yield part.reset_index(drop=True)


def _joined(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the rows, and for each row its start and length."""
    lengths = part["text"].map(len).to_numpy(np.int64)
    return np.frombuffer(b"".join(part["text"]), np.uint8), np.cumsum(lengths) - lengths, lengths


def _same(first: np.ndarray, second: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """An order by both numbers, and whether each but the first equals the one before it in both."""
    order = np.argsort(first)
    same = first[order][1:] == first[order][:-1]
    if second is not None:
        equal = second[order][1:] == second[order][:-1]
        if (same & ~equal).any():
            order = np.lexsort((second, first))
            same = first[order][1:] == first[order][:-1]
            equal = second[order][1:] == second[order][:-1]
        same &= equal
    return order, same


def _pack(h: np.ndarray, more: np.ndarray | None, doc: np.ndarray, pos: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries of a slice by bucket. Those equal to another of the slice are settled here, and one of them goes on for all."""
    order, same = _same(h, more)
    first, last = np.concatenate([[True], ~same]), np.concatenate([~same, [True]])
    many, sent = np.empty(len(h), np.uint8), np.empty(len(h), bool)
    many[order], sent[order] = ~(first & last), first
    columns: Columns = {"low": (h >> np.uint64(16)).astype("<u4"), "high": (h >> np.uint64(48)).astype("<u2"), "doc": doc, "pos": pos.astype("<u4"), "many": many}
    if more is not None:
        columns["more"] = more
    names = [name for name in FIELDS if name in columns]
    yield from _blobs((h[sent] % np.uint64(buckets)).astype(np.int64), {name: columns[name][sent] for name in names}, buckets, 0)
    settled = many == 1
    if settled.any():
        yield from _blobs(doc[settled] % buckets, {name: columns[name][settled] for name in ("doc", "pos")}, buckets, 1)


def _blobs(bucket: np.ndarray, columns: Columns, buckets: int, kind: int) -> Iterator[pa.RecordBatch]:
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    bucket = bucket[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(starts[1:], len(bucket)).tolist()
    ordered = [np.ascontiguousarray(values[order]) for values in columns.values()]
    parts = [b"".join([values[a:b].tobytes() for values in ordered]) for a, b in zip(starts.tolist(), ends)]
    arrays = [pa.array(bucket[starts]), pa.array(np.full(len(starts), kind, np.int8)), pa.array(parts, pa.binary())]
    yield pa.RecordBatch.from_arrays(arrays, ["bucket", "kind", "blob"])


def _unpack(blobs: list[bytes], fields: dict[str, str]) -> Columns:
    each = sum(np.dtype(kind).itemsize for kind in fields.values())
    counts = [len(blob) // each for blob in blobs]
    out, before = {}, 0
    for name, kind in fields.items():
        width = np.dtype(kind).itemsize
        out[name] = np.frombuffer(b"".join([blob[before * n : (before + width) * n] for blob, n in zip(blobs, counts)]), kind)
        before += width
    return out


def _flags(doc: np.ndarray, pos: np.ndarray, kind: int = 0) -> pa.RecordBatch:
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order].astype("<u4")
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    lists = [pos[a:b].tobytes() for a, b in zip(starts.tolist(), np.append(starts[1:], len(doc)).tolist())]
    lists, none = pa.array(lists, pa.binary()), pa.nulls(len(lists), pa.binary())
    columns = [pa.array(doc[starts], pa.int64()), none if kind else lists, lists if kind else none]
    return pa.RecordBatch.from_arrays(columns, ["doc", "places", "models"])


def _sort_buckets(batches: Iterator[pa.RecordBatch], fields: dict[str, str], models: bool) -> Iterator[pa.RecordBatch]:
    """One suffix bucket after the other is sorted; entries with an equal neighbour are returned by document.

    With ``models``: of entries equal in hash that differ in ``more``, one of each ``more`` that is there twice.
    """
    now, held, settled = None, [], []

    def settle() -> Iterator[pa.RecordBatch]:
        if settled:
            found = _unpack(settled, {"doc": FIELDS["doc"], "pos": FIELDS["pos"]})
            yield _flags(found["doc"], found["pos"])
        if not held:
            return
        own = _unpack(held, fields)
        h = own["low"].astype(np.uint64) | own["high"].astype(np.uint64) << np.uint64(32)
        order, same = _same(h, own.get("more"))
        head, many = np.concatenate([[True], ~same]), own["many"][order] == 1
        twice = ~head
        twice[:-1] |= same
        if models:
            often = np.bincount(np.cumsum(head) - 1, twice | many) > 0
            _, sizes = np.unique(h[order][head], return_counts=True)
            model = order[head][often & np.repeat(sizes > 1, sizes)]
            if len(model):
                yield _flags(own["doc"][model], own["pos"][model], 1)
        found = order[twice & ~many]  # the others have been returned by the task that met them
        if len(found):
            yield _flags(own["doc"][found], own["pos"][found])

    for batch in batches:
        for bucket, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if bucket != now:
                yield from settle()
                now, held, settled = bucket, [], []
            (settled if kind else held).append(blob)
    yield from settle()


def repeated(rows: DataFrame, places: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]], length: int, kind: str | None, size: int, turn: tuple[int, int] = (0, 1)) -> DataFrame:
    """``doc places models``: which of the wanted strings occur at two places or more.

    ``rows`` has ``doc``, ``text`` (binary) and what ``places`` needs, which gives the row numbers and the positions in
    the row that are looked at, each with ``length`` bytes. ``kind`` is ``PROPOSES`` or ``DECIDES`` by the bits that are
    compared, or ``SURROUNDINGS``: then they count as equal only if the ``PERIOD - 1`` bytes before and the ``LENGTH`` bytes
    from the position on are equal too, and ``models`` has one of each such group for the strings that also occur in other surroundings. About ``size`` bytes of entries are
    expected in all; they are dealt to buckets by the string's hash. ``turn`` (number, of how many) takes only a part of the hashes.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(partitions, size // (4 * BUCKET))
    buckets = 4 * partitions

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            data, starts, lengths = _joined(part)
            row, pos = places(part)
            real = pos + length <= lengths[row]
            row, pos = row[real], pos[real]
            if not len(row):
                continue
            at, docs = starts[row] + pos, part["doc"].to_numpy(np.int64)[row]
            h, more = Hashes(data, BASES[0]).of(at, length), None
            if kind == SURROUNDINGS:  # at the edge of a document nothing has the same surroundings
                more = docs.view(np.uint64) * np.uint64(BASES[0]) + pos.astype(np.uint64) * np.uint64(BASES[1])
                inner = (pos >= PERIOD - 1) & (pos + LENGTH <= lengths[row])
                more[inner] = Hashes(data, BASES[1]).of(at[inner] - PERIOD + 1, PERIOD - 1 + LENGTH)
            elif kind == DECIDES:
                more = (Hashes(data, BASES[1]).of(at, length) >> np.uint64(32)).astype("<u4")
            if turn[1] > 1:
                own = (h >> np.uint64(40)) % np.uint64(turn[1]) == turn[0]
                h, more, docs, pos = h[own], None if more is None else more[own], docs[own], pos[own]
            if len(h):
                yield from _pack(h, more, docs, pos, buckets)

    fields = {name: of or kind for name, of in FIELDS.items() if of or kind}
    packed = rows.mapInArrow(enter, "bucket long, kind byte, blob binary").repartition(partitions, "bucket").sortWithinPartitions("bucket")
    sort = lambda batches: _sort_buckets(batches, fields, kind == SURROUNDINGS)
    found = packed.mapInArrow(sort, "doc long, places binary, models binary")
    return found.groupBy("doc").agg(F.collect_list("places").alias("places"), F.collect_list("models").alias("models"))


def _ranges(lists) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and positions of a column of lists of binary arrays."""
    parts = [np.frombuffer(b"".join(x), "<u4") if x is not None else np.zeros(0, "<u4") for x in lists]
    return np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.concatenate([np.zeros(0, "<u4"), *parts]).astype(np.int64)


def _cover_places(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Positions of every row in the difference cover."""
    lengths = part["text"].map(len).to_numpy(np.int64)
    longest = int(lengths.max(initial=0))
    every = (np.arange(0, longest + 1, PERIOD)[:, None] + np.array(COVER)).ravel()
    counts = np.searchsorted(every, lengths, "left")
    row = np.repeat(np.arange(len(lengths)), counts)
    return row, every[np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)]


def _sampled_places(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return _ranges(part["sampled"])


def _marks(row: np.ndarray, first: np.ndarray, after: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bytes in any of the spans of the rows."""
    total = int(lengths.sum())
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts[row] + np.clip(first, 0, lengths[row]), 1)
    np.add.at(edge, starts[row] + np.clip(after, 0, lengths[row]), -1)
    return np.cumsum(edge[:-1]) > 0


def _open_places(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Starts of strings of ``LENGTH`` around repeated samples that are not settled, and around models.

    Of two equal strings one common sample is in both. If it is settled in both, with the same surroundings, so are the
    strings; if it is settled in one only, a model of that one is here for the other to meet.
    """
    _, starts, lengths = _joined(part)
    marks = np.zeros(int(lengths.sum()) + 1, bool)
    row, pos = _ranges(part["sampled"])
    settled_row, settled = _ranges(part["inside"])
    marks[starts[row] + pos] = True
    marks[starts[settled_row] + settled] = False
    row, pos = _ranges(part["models"])
    marks[starts[row] + pos] = True
    at = np.flatnonzero(marks)
    row = np.searchsorted(starts, at, "right") - 1
    pos = at - starts[row]
    at = np.flatnonzero(_marks(row, pos - PERIOD + 1, pos + 1, starts, lengths))
    row = np.searchsorted(starts, at, "right") - 1
    return row, at - starts[row]


def _removed(part: pd.DataFrame) -> np.ndarray:
    _, starts, lengths = _joined(part)
    row, pos = _ranges(part["inside"])
    gone = _marks(row, pos - PERIOD + 1, pos + LENGTH, starts, lengths)
    row, pos = _ranges(part["windows"])
    return gone | _marks(row, pos, pos + LENGTH, starts, lengths)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry=(), keep: bool = True) -> DataFrame:
    """``row`` (id and ``carry``), ``n_bytes n_removed n_spans kept_sha256`` for every row of ``df``, with ``keep`` also ``kept`` (binary).

    Removed is every byte in a string of 200 bytes that starts at another place too, in any document, judged on the input.

    Positions in a difference cover modulo 133 are the sample, 12 in 133. Two equal strings of 200 bytes have
    a common sampled offset with 68 equal bytes from it on, so only strings that hold a repeated sample can be repeated. The sample's
    suffixes are sorted bucket by bucket to that depth first. Its repeated members are then sorted with 132 bytes
    before and 200 bytes from them on: where that whole is repeated, so are all 133 strings that it holds, and
    long ties are settled by the sample's order without sorting their suffixes. The suffixes left, around the ends of repeats,
    are sorted to depth 200, again bucket by bucket, together with one model of each settled string that they may equal.
    Suffixes are compared by hashes of the depth in question, of over 80 bits (the first sort only proposes, by over 48), so no text is
    shuffled with them. Equal suffixes of a task are joined before the shuffle, so copies of one text are a few entries.

    Null and empty texts have nothing to remove, as have texts under 200 bytes. Repeated rows are repeats of each other.
    """
    text = text_or_empty(text_col).cast("binary")
    rows = df.select(
        F.struct(F.col(id_col).alias("id"), *carry).alias("row"), F.xxhash64(F.col(id_col), text).alias("doc"), text.alias("text")
    )
    total = df.agg(F.sum(F.octet_length(text_or_empty(text_col)))).first()[0] or 0
    sample = stage(repeated(rows.select("doc", "text"), _cover_places, SAMPLE, PROPOSES, total * 2))
    marked = rows.join(sample.select("doc", F.col("places").alias("sampled")), "doc", "left")
    clean = F.col("sampled").isNull()
    marked = stage(
        marked.select(
            "row", "sampled",
            F.monotonically_increasing_id().alias("doc"),
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.when(clean, F.sha2("text", 256)).alias("sha"),
            F.when(~clean | F.lit(keep), F.col("text")).alias("text"),
        )
    )
    dirty = marked.filter(F.col("sampled").isNotNull())
    inside = stage(repeated(dirty.select("doc", "text", "sampled"), _sampled_places, SAMPLE, SURROUNDINGS, total // 2))
    dirty = stage(dirty.join(inside.withColumnRenamed("places", "inside"), "doc", "left"))
    left = dirty.select("doc", "text", "sampled", "inside", "models")
    parts = [stage(repeated(left, _open_places, LENGTH, DECIDES, total // ROUNDS, (turn, ROUNDS))) for turn in range(ROUNDS)]
    windows = reduce(DataFrame.unionByName, parts).groupBy("doc").agg(F.flatten(F.collect_list("places")).alias("windows"))
    dirty = dirty.join(windows, "doc", "left").select("row", "n_bytes", "text", "inside", "windows")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for number in range(len(frame)):
                part = frame.iloc[number : number + 1]
                gone = _removed(part)
                data = np.frombuffer(part["text"].iloc[0], np.uint8)
                kept = data[~gone].tobytes()
                spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                out.append((int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if keep else None))
            yield pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256", "kept"])

    cutting = F.pandas_udf(cut, "n_removed long, n_spans long, kept_sha256 string, kept binary")
    both = dirty.select("row", "n_bytes", cutting(F.struct("text", "inside", "windows")).alias("cut")).select("row", "n_bytes", "cut.*")
    none = F.lit(0).cast("long")
    whole = marked.filter(clean).select("row", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), F.col("sha").alias("kept_sha256"), F.col("text").alias("kept"))
    found = whole.unionByName(both)
    return found if keep else found.drop("kept")


@query("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir, "doc_id", "text"), keep=False)
    return found.select(F.col("row.id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
