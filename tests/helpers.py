"""Records and small readers that the tests share."""

from __future__ import annotations

import json

from hybridframe.schema import RECORD


def frame(spark, rows):
    """Records from (id, document, vector, metadata dictionary or text)."""
    made = [(i, d, v, m if m is None or isinstance(m, str) else json.dumps(m)) for i, d, v, m in rows]
    return spark.createDataFrame(made, RECORD)


FIVE = [
    ("r1", "Copper kettle with a wooden handle", [4.0, 0.0, 1.0], {"kind": "kettle", "price": 60, "room": "kitchen"}),
    ("r2", "Linen curtain in pale green", [0.0, 5.0, 2.0], {"kind": "textile", "price": 35, "room": "bedroom"}),
    ("r3", "Small copper pan without a lid", [4.0, 1.0, 1.0], {"kind": "pan", "price": 48, "room": "kitchen"}),
    ("r4", "Green wool blanket", [0.0, 6.0, 2.5], {"kind": "textile", "price": 80, "room": "bedroom"}),
    ("r5", "Enamel kettle, two litres", [4.0, 2.0, 2.0], {"kind": "kettle", "price": 25, "room": "tent"}),
]

EIGHT = [
    ("h1", "Forest path along the river", [0.0, 1.0, 2.0], {"area": "north", "day": 1, "metres": 420, "season": "spring"}),
    ("h2", "Bare ridge above the tree line", [5.0, 5.0, 0.0], {"area": "south", "day": 2, "metres": 1900, "season": "summer"}),
    ("h3", "Gravel path to the old mill", [0.0, 1.5, 2.0], {"area": "north", "day": 3, "metres": 380, "season": "spring"}),
    ("h4", "Forest road and a steep path over the ridge", [5.0, 4.0, 1.0], {"area": "south", "day": 4, "metres": 1250, "season": "summer"}),
    ("h5", "Boardwalk through the moor", [1.0, 1.0, 2.0], {"area": "north", "day": 5, "metres": 300, "season": "autumn"}),
    ("h6", "A path between two lakes, forest on both sides", [0.0, 3.0, 2.0], {"area": "north", "day": 6, "metres": 510, "season": "spring"}),
    ("h7", "Ridge walk for a long day", [6.0, 5.0, 1.0], {"area": "south", "day": 7, "metres": 1700, "season": "summer"}),
    ("h8", "Winter forest path with snowshoes", [0.0, 4.0, 3.0], {"area": "north", "day": 8, "metres": 640, "season": "winter"}),
]


def ids(df) -> set[str]:
    return {row["_id"] for row in df.select("_id").collect()}


def ranked(df) -> list[str]:
    return [row["_id"] for row in sorted(df.collect(), key=lambda row: row["rank"])]
