"""Small results as dictionaries of lists. Large ones stay DataFrames."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F

from hybridframe.operators.nearest import QUERY_ID
from hybridframe.schema import DOCUMENT, EMBEDDING, ID, METADATA, included

PLURAL = {DOCUMENT: "documents", EMBEDDING: "embeddings", METADATA: "metadatas"}


def nested(hits: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per query: its hits as an array of structs in rank order."""
    columns = [c for c in hits.columns if c not in (QUERY_ID, "rank")]
    return hits.groupBy(QUERY_ID).agg(F.sort_array(F.collect_list(F.struct("rank", *columns, *extra))).alias("hits"))


def _value(field: str, value):
    if field == METADATA:
        if value is None:
            return {}
        try:
            return json.loads(value)
        except ValueError:
            return value
    if field == EMBEDDING and value is not None:
        return [float(x) for x in value]
    return value


def flat_dict(records: DataFrame, include=None) -> dict:
    """Parallel lists in id order."""
    rows = sorted(records.collect(), key=lambda row: row[ID])
    result = {"ids": [row[ID] for row in rows]}
    for field in included(include):
        result[PLURAL[field]] = [_value(field, row[field]) for row in rows]
    return result


def nested_dict(hits: DataFrame, queries: int, include=None, measure: str = "distance") -> dict:
    """Lists of lists, one inner list per query, in rank order; a query without hits has an empty one."""
    lists: list[list] = [[] for _ in range(queries)]
    for row in hits.collect():
        lists[row[QUERY_ID]].append(row)
    for rows in lists:
        rows.sort(key=lambda row: row["rank"])
    result = {"ids": [[row[ID] for row in rows] for rows in lists]}
    result["distances"] = [[row[measure] for row in rows] for rows in lists]
    for field in included(include):
        result[PLURAL[field]] = [[_value(field, row[field]) for row in rows] for rows in lists]
    return result
