"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as a state machine."""

from __future__ import annotations

import codecs
import functools
import hashlib
import itertools
import json
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridframe.llm.common import documents, query

# The code points of the White_Space property.
WHITE_SPACE = "\t\n\v\f\r \x85\xa0                　"
OTHER, LETTER, NUMBER, SPACE = range(4)
# What may follow an apostrophe to make one pre-token with it.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")

# Characters handed to the transducer at a time, and pre-tokens that a worker remembers.
CHUNK = 1 << 16
REMEMBERED = 400_000
# Pre-tokens of more bytes than this are encoded window by window.
WINDOW = 512


@functools.lru_cache(1)
def char_classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
    table[[ord(c) for c in WHITE_SPACE]] = SPACE
    return table


def boundaries(text: str) -> list[int]:
    """Where the pre-tokens of ``text`` start."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = char_classes()[codes]
    start = np.empty(len(kind), bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    space = kind == SPACE
    # one blank goes with what follows; the last space before something stands alone otherwise
    start[1:] &= space[1:] | (codes[:-1] != 32)
    start[:-1] |= space[:-1] & ~space[1:]
    for i in np.flatnonzero((codes == 39) & start).tolist():
        for tail in CONTRACTIONS:
            if text.startswith(tail, i + 1):
                start[i + 1] = False
                if i + 1 + len(tail) < len(start):
                    start[i + 1 + len(tail)] = True
                break
    return np.flatnonzero(start).tolist()


class Vocabulary:
    """A byte-level BPE vocabulary file: tokens as bytes, ranks of merges, and the lookahead that its merges need."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = {char: byte for byte, char in enumerate(self._printable())}
        as_bytes = lambda token: bytes(to_byte[c] for c in token)
        self.ids = {as_bytes(token): i for token, i in spec["model"]["vocab"].items() if all(c in to_byte for c in token)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for text in self.special:
            self.ids.pop(text.encode(), None)
        self.bytes = [b""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in self.ids.items():
            self.bytes[i] = token
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = [(as_bytes(a), as_bytes(b)) for a, b in pairs]
        self.merges = {}
        for rank, (a, b) in enumerate(pairs):
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.lookahead = self._lookahead(pairs)

    @staticmethod
    def _printable() -> list[str]:
        """The character that stands for each byte in the file: itself where printable, else one past U+00FF."""
        keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = iter(range(256, 512))
        return [chr(b) if b in set(keep) else chr(next(other)) for b in range(256)]

    @staticmethod
    def _lookahead(pairs: list[tuple[bytes, bytes]]) -> int:
        """Bytes to the right of a token's end that can decide whether the token ends there.

        Whether ``a b`` merges at rank r depends on bytes right of ``b`` only if some token y on the
        right edge of ``b`` can be taken by a merge ``y z`` of a lower rank than the one that takes y
        into ``b``; then on z, and on what z itself depends on. Ranks fall along such a chain, so in
        the order of the merges all that is needed is known already.
        """
        reach: dict[bytes, int] = {}  # bytes right of y that decide about merges y z so far
        made: dict[bytes, tuple[bytes, int]] = {}  # token: its right half, and what decided that half then
        edges: dict[bytes, int] = {}

        def edge(token: bytes) -> int:
            """What decides that the token forms at all."""
            most = 0
            while token in made:
                token, decided = made[token]
                most = max(most, decided)
            return most

        for a, b in pairs:
            decided = max(reach.get(b, 0), edge(b))
            if a + b not in made:
                made[a + b] = (b, decided)
            edges[a + b] = max(edges.get(a + b, 0), decided)
            reach[a] = max(reach.get(a, 0), len(b) + decided)
        return max([1, *reach.values(), *edges.values()])

    def encode_piece(self, piece: bytes) -> list[int]:
        """Tokens of one pre-token: the adjacent pair of the lowest rank is merged, until none is left."""
        whole = self.ids.get(piece)
        parts = [self.single[b] for b in piece]
        if whole is not None and len(piece) == 1:
            return parts
        find = self.merges.get
        none = (1 << 40, 0)
        ranks = [find(pair, none) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best is none or best[0] == none[0]:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [best[1]]
            del ranks[i]
            if i:
                ranks[i - 1] = find((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = find((parts[i], parts[i + 1]), none)
        return parts

    def encode_long(self, piece: bytes) -> Iterator[int]:
        """The same for a piece of any length: a token leaves once the lookahead behind it has been seen."""
        at = 0
        size = WINDOW + self.lookahead
        while len(piece) - at > size:
            done = 0
            for token in self.encode_piece(piece[at : at + size]):
                if done + len(self.bytes[token]) + self.lookahead > size:
                    break
                done += len(self.bytes[token])
                yield token
            at += done
            size = WINDOW + self.lookahead if done else size * 2
        yield from self.encode_piece(piece[at:])


@functools.lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Remembered(dict):
    """Tokens of pre-tokens met by this worker; forgets all when full, so memory is bounded."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab = vocab

    def __missing__(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8", "surrogatepass")
        if len(raw) > WINDOW:
            return tuple(self.vocab.encode_long(raw))
        if len(self) >= REMEMBERED:
            self.clear()
        tokens = self[piece] = tuple(self.vocab.encode_piece(raw))
        return tokens


@functools.lru_cache(4)
def remembered(path: str) -> Remembered:
    return Remembered(vocabulary(path))


def pieces(text: str, vocab: Vocabulary) -> Iterator[str | list[str]]:
    """Lists of pre-tokens of ``text`` in order, read in chunks; a special token comes alone, as a string."""
    at, places = 0, {special: text.find(special) for special in vocab.special}
    while True:
        # the next special token, the longest of those that begin at one place
        start, _, special = min(((place, -len(s), s) for s, place in places.items() if place >= 0), default=(len(text), 0, None))
        if start > at:
            yield from _chunked(text, at, start)
        if special is None:
            return
        yield special
        at = start + len(special)
        places = {s: place if place < 0 or place >= at else text.find(s, at) for s, place in places.items()}


def _chunked(text: str, at: int, stop: int) -> Iterator[list[str]]:
    """A pre-token is stable when it ends 4 characters before the end of what was read and is not the last one."""
    size = CHUNK
    while at < stop:
        part = text[at : min(stop, at + size)]
        starts = boundaries(part)
        if at + size < stop:
            ends = [b for b in starts[-8:] if 0 < b <= len(part) - 4]
            if len(starts) > 1 and ends and ends[-1] == starts[-1]:
                ends.pop()
            if not ends:
                size *= 2  # one long pre-token
                continue
            starts = starts[: starts.index(ends[-1]) + 1]
            yield [part[a:b] for a, b in zip(starts, starts[1:])]
            at, size = at + starts[-1], CHUNK
        else:
            yield [part[a:b] for a, b in zip(starts, [*starts[1:], len(part)])]
            return


def encode(text: str, path: str) -> Iterator[tuple[int, ...]]:
    """Token ids of ``text``, a tuple per pre-token."""
    vocab, memory = vocabulary(path), remembered(path)
    for part in pieces(text, vocab):
        if isinstance(part, str):
            yield (vocab.special[part],)
        else:
            yield from map(memory.__getitem__, part)


def decode(ids: Iterable[int], path: str) -> Iterator[str]:
    """The text of token ids, in parts: bytes go through a UTF-8 state machine that keeps an unfinished character."""
    table = vocabulary(path).bytes
    machine, ids = codecs.getincrementaldecoder("utf-8")("replace"), iter(ids)
    while some := list(itertools.islice(ids, CHUNK)):
        yield machine.decode(b"".join(map(table.__getitem__, some)))
    yield machine.decode(b"", True)


def encode_frame(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", carry=()) -> DataFrame:
    """``row`` (id and ``carry``), ``ids array<int>`` for every row. A null text is an empty one and has no tokens.

    Repeated rows and null ids are rows like others, columns of any name are carried in ``row``, an empty table gives an empty result. The ids of a
    text are one array; ``digests`` needs no more than a chunk of a text of any length.
    """

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([np.fromiter((i for part in encode(t or "", path) for i in part), np.int32) for t in texts], dtype=object)

    return df.select(F.struct(F.col(id_col).alias("id"), *carry).alias("row"), run(F.col(text_col)).alias("ids"))


def decode_frame(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Adds the decoded text to rows with token ids; null ids are none."""

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        return pd.Series(["".join(decode(() if i is None else i, path)) for i in ids], dtype=object)

    return df.withColumn(text_col, run(F.col(ids_col)))


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id n_tokens ids_sha256 decoded_sha256`` of every row, without token lists leaving the worker.

    Ids are hashed and decoded as they leave the transducer, ``CHUNK`` of them at a time, so besides the text itself its length
    does not count. A null text is an empty one; repeated rows and null ids are rows like others; an empty table gives an empty result.
    """

    def run(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = vocabulary(path).bytes
        decimal = [str(i) for i in range(len(table))]
        for texts in columns:
            rows = []
            for text in texts:
                count, written, read = 0, hashlib.sha256(), hashlib.sha256()
                machine = codecs.getincrementaldecoder("utf-8")("replace")
                ids = itertools.chain.from_iterable(encode(text or "", path))
                while some := list(itertools.islice(ids, CHUNK)):
                    written.update((b"," if count else b"") + ",".join(map(decimal.__getitem__, some)).encode())
                    read.update(machine.decode(b"".join(map(table.__getitem__, some))).encode())
                    count += len(some)
                read.update(machine.decode(b"", True).encode())
                rows.append((count, written.hexdigest(), read.hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    found = F.pandas_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    rows = df.select(F.col(id_col).alias("id"), found(F.col(text_col)).alias("found"))
    return rows.select("id", "found.*")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op6_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir, "doc_id", "text"), default_path()).withColumnRenamed("id", "doc_id")
