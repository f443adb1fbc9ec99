"""Tokens and term counts.

A term is a maximal run of Unicode letters and digits, in lower case.
"""

from __future__ import annotations

import regex
from pyspark.sql import Column, functions as F

from hybridframe.functions.columns import let

BREAK = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """All terms of a text in order, repeats kept; NULL for a null text."""
    return F.array_remove(F.split(F.lower(text), BREAK), "")


def split_terms(text: str) -> list[str]:
    """All terms of a string given in Python."""
    return [term for term in regex.split(BREAK, str(text).lower()) if term]


def distinct_terms(text: str) -> list[str]:
    """Terms of a query string given in Python, in order, once each."""
    return list(dict.fromkeys(split_terms(text)))


def term_frequency(terms: Column, term: str) -> Column:
    """How often ``term`` occurs in an array of terms."""
    return F.size(terms) - F.size(F.array_remove(terms, term))


def term_counts(terms: Column) -> Column:
    """``array<struct<term, tf>>``: the distinct terms of one document with their counts.

    A document is one row, so its counts need no shuffle: sort its terms and measure the runs.
    """

    def runs(ordered: Column) -> Column:
        length = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(1), length),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, k: F.struct(
                    F.get(ordered, start - 1).alias("term"),
                    (F.coalesce(F.get(at, k + 1), length + 1) - start).alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(terms), lambda ordered: F.when(F.size(ordered) > 0, runs(ordered)))
