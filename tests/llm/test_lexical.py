"""Ranked lexical search against every document scored one by one."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row

from hybridframe.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(SMALL) for t in TERM.findall(text or "")]


def brute_force(docs, items, k=10):
    """Rows ``(item_id, rank, doc_id, score)`` of documents and items ``(id, text)``."""
    counts = [Counter(terms(text)) for _, text in docs]
    n_docs, total = sum(bool(c) for c in counts), sum(sum(c.values()) for c in counts)
    df, found = Counter(t for c in counts for t in c), []
    for item, text in items:
        scored = []
        for (doc, _), own in zip(docs, counts):
            if own:
                m = 100 - 75 + (75 * sum(own.values()) * n_docs) // total
                score = sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * own[t]) // (1000 * own[t] + 8 * m))
                    for t in terms(text) if own[t]
                )
                if score > 0:
                    scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        found += [(item, rank, doc, -less) for rank, (less, _, doc) in enumerate(scored[:k], 1)]
    return found


@pytest.fixture
def collection():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "naïve", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 80))) for _ in range(300)]
    texts += [None, "", "... \n", "É-È", texts[0], texts[0], texts[0], texts[1].upper(), "w1 " * 5000, "w1"] + ["w0 w1 w2 w0"] * 70
    ids = [*range(len(texts) - 3), 4, None, None]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(12)]
    items += [(90, "w1"), (91, "w1 w1 W1"), (92, None), (93, ""), (94, "unknown words"), (95, "w0 w1 w2 w0"), (None, "w3"), (96, texts[0]), (90, "w2")]
    return list(zip(ids, texts)), items


@pytest.mark.parametrize(("entries", "leaf"), [(1 << 20, 24), (300, 2)])
def test_search(spark, docs, collection, monkeypatch, entries, leaf):
    monkeypatch.setattr(lexical, "ENTRIES", entries)
    monkeypatch.setattr(lexical, "LEAF", leaf)
    texts, items = collection
    frame = docs([t for _, t in texts], [i for i, _ in texts])
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, rank int")
    got = [tuple(row) for row in lexical.search(frame, asked).select("item_id", "rank", "doc_id", "score").collect()]
    key = lambda row: tuple((v is None, v or 0) for v in row)
    assert sorted(got, key=key) == sorted(brute_force(texts, items), key=key)


def test_blocks_of_items_give_the_same_rows(spark, docs, collection, monkeypatch):
    texts, items = collection
    frame = docs([t for _, t in texts[:60]], range(60))
    asked = spark.createDataFrame(items[:6], "item_id long, text string")
    whole = lexical.search(frame, asked, 3).collect()
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 200)
    assert sorted(lexical.search(frame, asked, 3).collect()) == sorted(whole)


def test_empty_tables(spark, docs):
    frame, asked = docs(["one two"]), spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical.search(frame.limit(0), asked).count() == 0
    assert lexical.search(frame, asked.limit(0)).count() == 0
    assert lexical.search(frame, asked).columns == ["item_id", "rank", "doc_id", "score"]


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = "ab  cd-" * 50 + "e" * 40
    whole = [t for part in lexical.terms(text) for t in part]
    monkeypatch.setattr(lexical, "PIECE", 9)
    assert [t for part in lexical.terms(text) for t in part] == whole == [t.encode() for t in terms(text)]


def test_bounds_hold_and_subtrees_are_left_out(monkeypatch):
    """Every node's bound is at least the best score below it; a search for a rare term skips most leaves."""
    rng = np.random.default_rng(2)
    rows = sorted((sorted(set(rng.zipf(1.3, rng.integers(1, 20)) % 400)), int(rng.integers(25, 400))) for _ in range(3000))
    sizes = np.array([len(path) for path, _ in rows])
    ranks = np.array([t for path, _ in rows for t in path])
    tfs = rng.integers(1, 5, len(ranks))
    tree = lexical.Tree(list(range(3000)), np.array([m for _, m in rows]), sizes, ranks, tfs)
    line = np.zeros(400, np.int64)
    line[[3, 77, 301]] = 900, 5000, 7000
    scores = np.add.reduceat(line[ranks] * tree.scores, tree.starts[:-1])
    for node, (a, b) in enumerate(tree.stretch):
        assert int(line[tree.places[node]] @ tree.bounds[node]) >= scores[a:b].max()
    leaves = [s for node, s in enumerate(tree.stretch) if node not in tree.children]
    assert sum(b - a for a, b in leaves) == 3000 and sorted(leaves)[0][0] == 0
    visited, reduceat, top = [], np.add.reduceat, []

    class Counted:
        @staticmethod
        def reduceat(*args):
            visited.append(1)
            return reduceat(*args)

    monkeypatch.setattr(lexical.np, "add", Counted)
    tree.search(line, top, 10)
    monkeypatch.undo()
    assert sorted(-s for s, _ in top) == sorted(-scores)[:10]
    assert len(visited) < len(leaves) / 2


def test_query(spark):
    rows = lexical.op11(spark, "/root/testdata/sf0.001")
    assert dict(rows.dtypes) == {"item_id": dict(spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").dtypes)["item_id"], "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert isinstance(rows.first(), Row)
