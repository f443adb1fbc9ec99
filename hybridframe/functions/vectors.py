"""Distances between a vector column and a query, in double precision.

A smaller value always means closer, except for ``inner_product``, whose larger value is closer;
``closest_first`` gives the order to sort by.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, functions as F

from hybridframe.functions.columns import steady
from hybridframe.schema import METRICS

# A query of at most this many components becomes one generated sum, several times faster than a
# lambda over the array. Longer ones outgrow what the JIT compiles as one method.
UNROLL = 32


def metric_or_default(metric: str | None) -> str:
    if metric == "ip":
        return "inner_product"
    if metric in METRICS:
        return metric
    warnings.warn(f"unknown distance {metric!r}, using l2", stacklevel=2)
    return "l2"


def _total(vector: str, query: list[float] | str, term: str) -> Column:
    """Sum over all positions of ``term``, an SQL expression over the components ``a`` and ``b``.

    SQL text, because a sum of hundreds of terms is slow to put together from Column objects.
    """
    if isinstance(query, list) and len(query) <= UNROLL:
        terms = [
            "(" + term.format(a=f"cast(get(`{vector}`, {i}) as double)", b=f"({float(x)!r}D)") + ")" for i, x in enumerate(query)
        ]
        return F.expr(" + ".join(terms))
    other = f"array({', '.join(f'{float(x)!r}D' for x in query)})" if isinstance(query, list) else f"`{query}`"
    a, b = "cast(a as double)", "cast(b as double)"
    return F.expr(f"aggregate(zip_with(`{vector}`, {other}, (a, b) -> {term.format(a=a, b=b)}), 0D, (acc, x) -> acc + x)")


def inner_product(vector: str, query: list[float] | str) -> Column:
    return _total(vector, query, "{a} * {b}")


def l2_distance(vector: str, query: list[float] | str) -> Column:
    return F.sqrt(_total(vector, query, "({a} - {b}) * ({a} - {b})"))


def norm(vector: str) -> Column:
    return F.expr(f"sqrt(aggregate(`{vector}`, 0D, (acc, x) -> acc + cast(x as double) * cast(x as double)))")


def cosine_distance(vector: str, query: list[float] | str) -> Column:
    """``1 - cosine``, never below 0; NULL where a vector has no length."""
    if isinstance(query, list):
        norms = F.sqrt(_total(vector, query, "{a} * {a}")) * F.lit(sum(float(x) ** 2 for x in query) ** 0.5)
    else:
        norms = norm(vector) * norm(query)
    found = F.lit(1.0) - F.try_divide(inner_product(vector, query), norms)
    return F.when(found > 0, found).otherwise(F.abs(found * 0.0))


def distance(metric: str | None, vector: str, query: list[float] | str) -> Column:
    """Distance of a vector column to ``query``, a Python list or the name of another vector column; NULL where it is no number."""
    measure = {"l2": l2_distance, "cosine": cosine_distance, "inner_product": inner_product}[metric_or_default(metric)]
    measured = measure(vector, query)
    return F.when(~F.isnan(measured), measured)


def closest_first(metric: str | None, distance_column: str = "distance") -> Column:
    column = steady(F.col(distance_column))
    return column.desc_nulls_last() if metric_or_default(metric) == "inner_product" else column.asc_nulls_last()


def similarity(distance_column: Column) -> Column:
    """Display similarity of a distance: ``1 / (1 + d)``."""
    return F.lit(1.0) / (F.lit(1.0) + distance_column)
