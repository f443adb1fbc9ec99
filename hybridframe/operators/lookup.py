"""Text filters answered through an index: it proposes documents, and the filter itself is checked on their texts only.

Terms: a ``$contains`` is a semi-join with the postings of its terms. Trigrams: every three characters of a text are in an index; a
document with a literal has all trigrams of the literal. A regular expression gives the literals that every match must have, if
it has any; where nothing can be required, all documents are proposed.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridframe.functions.columns import let
from hybridframe.functions.predicates import where_document as document_predicate
from hybridframe.functions.text import distinct_terms
from hybridframe.operators.fulltext import PARTS, TextIndex, _part, postings_of
from hybridframe.operators.joins import join_small
from hybridframe.schema import DOCUMENT, ID

GRAM = 3


class GramIndex(NamedTuple):
    """``gram, _id`` by part."""

    grams: DataFrame
    parts: int


def distinct_grams(text: Column) -> Column:
    """The distinct trigrams of a text as an array; an empty one for shorter texts. Linear in the text's length: it is taken apart once."""

    def at(chars: Column) -> Column:
        last = F.size(chars) - (GRAM - 1)
        starts = F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(*[F.get(chars, i + step) for step in range(GRAM)]))

    return F.array_distinct(let(F.split(text, ""), at))


def write_grams(df: DataFrame, path: str, parts: int = PARTS) -> None:
    """Keep the distinct trigrams of every text. A part is cut into files of similar size, however frequent its trigrams are."""
    grams = F.explode(distinct_grams(F.col(DOCUMENT))).alias("gram")
    rows = df.filter(F.char_length(DOCUMENT) >= GRAM).select(ID, grams).withColumn("part", _part(F.col("gram"), parts))
    rows.hint("rebalance", "part").sortWithinPartitions("part", "gram").write.partitionBy("part").parquet(path)


def read_grams(spark: SparkSession, path: str, parts: int = PARTS) -> GramIndex:
    return GramIndex(spark.read.parquet(path), parts)


def required_literals(pattern: str) -> list[str]:
    """Strings that every match of the pattern contains, whatever else it does; none where that is not plain.

    Only runs of ordinary characters outside of groups and classes count, without the one before a quantifier. A pattern with alternatives, inline
    flags or anything unusual requires nothing.
    """
    if "|" in pattern or "(?" in pattern or "\\Q" in pattern:
        return []
    found, run, depth, i = [], "", 0, 0

    def end() -> None:
        nonlocal run
        found.append(run)
        run = ""

    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            escaped = pattern[i + 1 : i + 2]
            if escaped and not escaped.isalnum() and not depth:
                run += escaped
            else:
                end()
                if escaped in "xupPNcok0":
                    return []  # longer escapes are not taken apart
            i += 2
            continue
        if c == "[":
            end()
            close = re.compile(r"\[\^?\]?(?:\\.|[^\]\\\[])*\]", re.S).match(pattern, i)
            if close is None:
                return []
            i = close.end()
            continue
        if c == "(":
            end()
            depth += 1
        elif c == ")":
            end()
            depth -= 1
        elif c in "?*{":
            run = run[:-1]
            end()
            if c == "{":
                i = pattern.find("}", i)
                if i < 0:
                    return []
        elif c in "+.^$":
            end()
        elif not depth:
            run += c
        i += 1
    end()
    return [literal for literal in found if len(literal) >= GRAM]


def _with_all(index: GramIndex, literals: list[str]) -> DataFrame | None:
    grams = sorted({literal[i : i + GRAM] for literal in literals for i in range(len(literal) - GRAM + 1)})
    if not grams:
        return None
    rows = index.grams.filter(F.col("gram").isin(grams) & F.col("part").isin([_part(F.lit(gram), index.parts) for gram in grams]))
    # texts that share an id may share trigrams
    return rows.groupBy(ID).agg(F.count_distinct("gram").alias("n")).filter(F.col("n") == len(grams)).select(ID)


def proposed(where_document, terms: TextIndex | None, grams: GramIndex | None, mode: str = "terms") -> DataFrame | None:
    """Ids among which all matches are; None if that may be any document."""
    if isinstance(where_document, str):
        where_document = {"$contains": where_document}
    found = []
    for key, spec in where_document.items():
        one = None
        if key == "$contains" and mode == "terms" and terms is not None:
            words = distinct_terms(spec)
            one = postings_of(terms, words).select(ID).distinct() if words else None
        elif key == "$contains" and mode == "substring" and grams is not None:
            one = _with_all(grams, [spec])
        elif key == "$regex" and grams is not None:
            one = _with_all(grams, required_literals(spec))
        elif key == "$and":
            parts = [part for part in (proposed(sub, terms, grams, mode) for sub in spec) if part is not None]
            for part in parts:
                one = part if one is None else one.join(part, ID, "left_semi")
        elif key == "$or":
            parts = [proposed(sub, terms, grams, mode) for sub in spec]
            if parts and all(part is not None for part in parts):
                one = parts[0]
                for part in parts[1:]:
                    one = one.unionByName(part)
                one = one.distinct()
        if one is not None:
            found.append(one)
    if not found:
        return None
    ids = found[0]
    for part in found[1:]:
        ids = ids.join(part, ID, "left_semi")
    return ids


def select_documents(df: DataFrame, where_document, terms: TextIndex | None = None, grams: GramIndex | None = None, mode: str = "terms") -> DataFrame:
    """The records of ``df`` that pass a text filter, with the same result as reading all texts. Unknown keys raise."""
    passes = document_predicate(where_document, F.col(DOCUMENT), mode)
    ids = proposed(where_document, terms, grams, mode)
    candidates = df if ids is None else join_small(df, ids.distinct(), ID, "left_semi", salt_by=None)
    return candidates.filter(_true(passes))


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def texts_read(df: DataFrame, where_document, terms: TextIndex | None = None, grams: GramIndex | None = None, mode: str = "terms") -> DataFrame:
    """One row ``texts, read``: all texts, and those that the filter is checked on."""
    ids = proposed(where_document, terms, grams, mode)
    all_ = df.agg(F.count(DOCUMENT).alias("texts"))
    return all_.withColumn("read", F.col("texts") if ids is None else ids.agg(F.count_distinct(ID).alias("read")).scalar())
