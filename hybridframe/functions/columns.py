"""Small column helpers shared by the expression modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


# A multiple that leaves 39 of the 53 bits of a double.
_CUT = 2.0**14 + 1.0


def steady(value):
    """A double without its last 14 bits, relative to its size; for columns and arrays.

    That takes off the noise of summing in another order, so that equal records tie, and keeps close ones apart however small
    they are. Plain arithmetic, so Spark and NumPy agree to the bit.
    """
    scaled = value * _CUT
    return scaled - (scaled - value)
