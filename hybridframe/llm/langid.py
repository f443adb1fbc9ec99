"""Language identification: script ranges, scores per word, and a Viterbi path that labels spans."""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridframe.llm.common import documents, query

# Character n-grams are counted in this many cells, for any corpus: the model is cells x languages numbers.
CELLS = 1 << 16
GRAMS = (2, 3, 4)
# The score of a word that changes language is this much lower (natural logarithm).
SWITCH = 12.0
# Documents of a batch that are scored together, in characters.
SLICE = 2_000_000

# First code points of the ranges of the larger scripts; all other letters count as one script.
SCRIPTS = (
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"),
    (0xFE00, "other"), (0x20000, "han"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})


@functools.lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: its lower-case form, 0 if it is neither letter nor mark; and its script's number."""
    lower = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if char.isalpha() or unicodedata.category(char) in ("Mn", "Mc"):
            low = char.lower()
            lower[code] = ord(low) if len(low) == 1 else code
    starts = np.array([start for start, _ in SCRIPTS])
    numbers = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS], np.int8)
    scripts = numbers[np.maximum(np.searchsorted(starts, np.arange(sys.maxunicode + 1), "right") - 1, 0)]
    return lower, scripts


@functools.lru_cache(1)
def marks() -> np.ndarray:
    """The code points that belong to a word and are no letters themselves."""
    return np.array([unicodedata.category(chr(code)) in ("Mn", "Mc") for code in range(sys.maxunicode + 1)])


def letters_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters of the joined texts (0 between words), their scripts, and where each text starts."""
    lower, script = tables()
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0, *(len(text) + 1 for text in texts)])
    return lower[codes], script[codes], starts


def gram_cells(letters: np.ndarray) -> list[np.ndarray]:
    """For every n the cell of the n-gram that ends at each position; grams do not reach past a word's start."""
    cells, total = [], np.zeros(len(letters), np.uint64)
    within = np.ones(len(letters), bool)
    padded = np.concatenate([np.zeros(max(GRAMS), np.uint32), letters])
    for back in range(max(GRAMS)):
        part = padded[max(GRAMS) - back : len(padded) - back].astype(np.uint64)
        # beyond the blank before a word everything counts as blank
        part[~within] = 0
        within &= part != 0
        total = (total + part + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
        if back + 1 in GRAMS:
            cells.append(((total * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64) % CELLS)
    return cells


def train(df: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict:
    """The model from all rows of ``df`` with a language and a text.

    Tasks count n-gram cells and scripts per language for themselves and send sums; the driver gets
    at most ``CELLS`` x n-gram lengths x languages numbers. Without labelled rows there are no languages.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        for batch in batches:
            frame = batch.to_pandas()
            for lang, own in frame.groupby("lang")["text"]:
                sums = grams.setdefault(lang, np.zeros(len(GRAMS) * CELLS + len(SCRIPT_NAMES), np.int64))
                for texts in slices(own.tolist()):
                    letters, scripts, _ = letters_of(texts)
                    real = letters > 0
                    for n, cells in enumerate(gram_cells(letters)):
                        sums[n * CELLS : (n + 1) * CELLS] += np.bincount(cells[real], minlength=CELLS)
                    sums[len(GRAMS) * CELLS :] += np.bincount(scripts[real], minlength=len(SCRIPT_NAMES))
        for lang, sums in grams.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"lang": lang, "cell": at, "n": sums[at]}), preserve_index=False)

    rows = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = rows.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros((len(langs), len(GRAMS) * CELLS + len(SCRIPT_NAMES)))
    table[[langs.index(x) for x in counts["lang"]] if len(counts) else [], counts["cell"].to_numpy(np.int64)] = counts["n"]
    scores = []
    for n in range(len(GRAMS)):
        part = table[:, n * CELLS : (n + 1) * CELLS] + 0.5
        scores.append(np.log(part / part.sum(1, keepdims=True)).T.astype(np.float32) / len(GRAMS))
    scripts = table[:, len(GRAMS) * CELLS :]
    return {"langs": langs, "scores": scores, "allowed": (scripts > 0).T}


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Texts in lists of about ``SLICE`` characters; a longer text is alone in its list."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > SLICE:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def pieces(text: str) -> Iterator[tuple[int, str]]:
    """A long text, with the place of each piece; cut between words, or inside one that is longer than a piece."""
    start = 0
    while start < len(text):
        end = min(len(text), start + SLICE)
        cut = end
        while end < len(text) and cut > start and (text[cut - 1].isalpha() or unicodedata.category(text[cut - 1]) in ("Mn", "Mc")):
            cut -= 1
        end = cut if cut > start else end
        yield start, text[start:end]
        start = end


def scored(model: dict, texts: list[str]) -> tuple[np.ndarray, ...]:
    """Words of the texts: the text of each, its first and last character in it, its scores by language, and whether its script is known.

    A word is a run of letters and marks with at least one letter. Its candidates are the languages seen in its letters' scripts;
    where there is none, all are.
    """
    letters, scripts, starts = letters_of(texts)
    real, count = letters > 0, len(model["langs"])
    edge = np.diff(real.astype(np.int8), prepend=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    at = np.flatnonzero(real)
    if len(first):
        word_at = np.searchsorted(at, first)
        some = np.add.reduceat((~marks()[letters[at]]).astype(np.int32), word_at) > 0
    if not len(first) or not count or not some.any():
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros((0, count), np.float32), np.zeros(0, bool)
    total = np.zeros((len(at), count), np.float32)
    for scores, cells in zip(model["scores"], gram_cells(letters)):
        total += scores[cells[at]]
    words = np.add.reduceat(total, word_at, axis=0)[some]
    fits = (np.add.reduceat(model["allowed"][scripts[at]].astype(np.int32), word_at, axis=0) > 0)[some]
    known = fits.any(1)
    words = np.where(fits | ~known[:, None], words, np.float32(-1e6))
    first, last = first[some], last[some]
    doc = np.searchsorted(starts, first, "right") - 1
    return doc, first - starts[doc], last - starts[doc], words, known


def label(model: dict, texts: list[str]) -> tuple[np.ndarray, ...]:
    """Words of the texts: the text of each, its first and last character in it, its language's number, and whether its script is known."""
    if len(texts) == 1 and len(texts[0]) > SLICE:
        return label_long(model, texts[0])
    doc, first, last, words, known = scored(model, texts)
    return doc, first, last, viterbi(words, doc), known


def label_long(model: dict, text: str) -> tuple[np.ndarray, ...]:
    """The same for one long text, a piece at a time: the path's state goes on, and per word only its steps (a bit a language) are kept."""
    best, parts, steps = None, [], []
    for start, piece in pieces(text):
        _, first, last, words, known = scored(model, [piece])
        parts.append((first + start, last + start, known))
        stay, jump, best = forward(words, np.zeros(len(words), np.int64), best)
        steps.append((np.packbits(stay, axis=1), jump.astype(np.int16)))
    paths, now = [], None if best is None else best.argmax(1)
    for packed, jump in reversed(steps):
        stay = np.unpackbits(packed, axis=1, count=len(model["langs"])).astype(bool)
        path, now = backward(stay, jump.astype(np.int32), np.zeros(len(jump), np.int64), now)
        paths.append(path)
    first, last, known = (np.concatenate(column) for column in zip(*parts))
    return np.zeros(len(first), np.int64), first, last, np.concatenate(paths[::-1]), known


def _turns(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where documents begin, the longest first, and how many have more than k words."""
    begin = np.flatnonzero(np.diff(doc, prepend=-1))
    length = np.diff(np.append(begin, len(doc)))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    return begin, np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), "left")


def forward(words: np.ndarray, doc: np.ndarray, best: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Step k handles the k-th word of all documents that have one: where a path stays, where it comes from otherwise, and the last scores."""
    begin, active = _turns(doc)
    stay = np.empty(words.shape, bool)
    jump = np.empty(len(words), np.int32)
    best = np.zeros((max(1, len(begin)), words.shape[1]), np.float32) if best is None else best
    for k, n in enumerate(active):
        rows = begin[:n] + k
        top = best[:n].argmax(1)
        # scores are relative, so that a long text does not lose digits
        best[:n] -= best[np.arange(n), top][:, None]
        keep = best[:n] >= -SWITCH
        stay[rows], jump[rows] = keep, top
        best[:n] = np.where(keep, best[:n], -SWITCH) + words[rows]
    return stay, jump, best


def backward(stay: np.ndarray, jump: np.ndarray, doc: np.ndarray, now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The path that ends in ``now``, and the state before its first word."""
    begin, active = _turns(doc)
    path = np.empty(len(jump), np.int64)
    for k in range(len(active) - 1, -1, -1):
        rows = begin[: active[k]] + k
        state = now[: active[k]]
        path[rows] = state
        now[: active[k]] = np.where(stay[rows, state], state, jump[rows])
    return path, now


def viterbi(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Best path for every document at once."""
    if not len(words):
        return np.zeros(0, np.int64)
    stay, jump, best = forward(words, doc)
    return backward(stay, jump, doc, best.argmax(1))[0]


def identify(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", carry=()) -> DataFrame:
    """``row`` (a struct of the id and of ``carry``), ``lang_pred``, ``score`` and ``spans``, for every row of ``df``.

    ``lang_pred`` is the language of most letters' words on the path, ``score`` the share of the letters that are in its words and in a
    script known for it (a text in scripts that no language was seen in has score 0),
    ``spans`` the stretches of one language: first and last character, language. Null texts and texts
    without letters (marks alone are none) get ``und``, score 0 and no spans, as does everything if no language was learnt.

    Every row is labelled by itself, also repeated ones; ties between languages go to the first by name. Texts of any length are scored
    whole, long ones a piece at a time. An empty table gives an empty result.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in columns:
            parts = [_documents(own, part) for part in slices([text or "" for text in texts])]
            yield pd.concat(parts) if parts else pd.DataFrame({"lang_pred": [], "score": [], "spans": []})

    predict = F.pandas_udf(run, "lang_pred string, score double, spans array<struct<first:int,last:int,lang:string>>")
    predict = predict.asNondeterministic()  # so that a filter on the result doesn't have every text labelled twice
    rows = df.select(F.struct(F.col(id_col).alias("id"), *carry).alias("row"), F.col(text_col).alias("_text"))
    return rows.select("row", predict("_text").alias("found")).select("row", "found.lang_pred", "found.score", "found.spans")


def _documents(model: dict, texts: list[str]) -> pd.DataFrame:
    doc, first, last, path, known = label(model, texts)
    langs = np.array([*model["langs"], "und"], object)
    votes = np.zeros((len(texts), len(langs)))
    np.add.at(votes, (doc, path), last - first)
    total = votes.sum(1)
    top = np.where(total > 0, votes.argmax(1), len(langs) - 1)
    sure = np.zeros_like(votes)
    np.add.at(sure, (doc, path), (last - first) * known)
    score = sure[np.arange(len(texts)), top] / np.maximum(total, 1)
    new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(path, prepend=-1) != 0))
    ends = np.append(new[1:], len(doc)) - 1 if len(doc) else new
    spans = [[] for _ in texts]
    for d, a, b, lang in zip(doc[new].tolist(), first[new].tolist(), last[ends].tolist(), langs[path[new]]):
        spans[d].append({"first": a, "last": b, "lang": lang})
    return pd.DataFrame({"lang_pred": langs[top], "score": score, "spans": spans})


def held_out(id_col: str = "doc_id"):
    """A fifth of the documents, by the CRC-32 of the id as text; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = train(docs.filter(~held_out()))
    found = identify(docs, model)
    return found.select(F.col("row.id").alias("doc_id"), held_out("row.id").alias("held_out"), "lang_pred", "score")
