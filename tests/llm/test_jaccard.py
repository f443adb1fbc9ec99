"""Near copies by the similarity of five-word shingles, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hybridframe.llm import jaccard
from hybridframe.llm.common import measured
from hybridframe.llm.simhash import components

RNG = random.Random(11)
VOCABULARY = ["".join(RNG.choices("abcdefghij", k=6)) for _ in range(3000)]


def grams(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(x, y):
    return len(x & y) / len(x | y) if x | y else 1.0


def changed(words, n):
    words = list(words)
    for at in RNG.sample(range(len(words)), n):
        words[at] = RNG.choice(VOCABULARY)
    return words


@pytest.fixture(scope="module")
def texts():
    made = [None, "", " \n", "one two", "ONE two", "one two three"]
    for size, swaps in ((200, 1), (200, 2), (200, 4), (500, 3), (500, 9), (1000, 10), (40, 3)):
        for _ in range(12):
            base = RNG.choices(VOCABULARY, k=size)
            made += [" ".join(base), " ".join(changed(base, swaps))]
    # a chain in which neighbours are alike and the ends are not, and one long group of copies
    words = RNG.choices(VOCABULARY, k=300)
    for _ in range(12):
        made.append(" ".join(words))
        words = words[12:] + RNG.choices(VOCABULARY, k=12)
    base = RNG.choices(VOCABULARY, k=400)
    return made + [" ".join(changed(base, 2)) for _ in range(40)]


@pytest.mark.parametrize("pairs, tile", [(0, 5), (8, 1024), (256, 3)])
def test_components_are_those_of_all_pairs(docs, texts, monkeypatch, pairs, tile):
    monkeypatch.setattr(jaccard, "PAIRS", pairs)
    monkeypatch.setattr(jaccard, "TILE", tile)
    rows = jaccard.near_groups(docs(texts)).collect()
    sets, group = [grams(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if group[i] != group[j] and similarity(sets[i], sets[j]) >= 0.8:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    assert {r.row.id: r.component_id for r in rows} == dict(enumerate(group))
    assert sum(r.kept for r in rows) == len(set(group))


def test_the_stage_drops_planted_copies_of_one_changed_word(spark, docs):
    import corpus_pipeline

    made = []
    for _ in range(30):
        base = RNG.choices(VOCABULARY, k=200)
        made += [" ".join(base), " ".join(changed(base, 1))]
    frame = docs(made, [*range(len(made) - 1), None])
    rows = corpus_pipeline.near(spark, frame, "").collect()
    assert sorted(r.doc_id for r in rows) == list(range(0, 60, 2)) and rows[0].asDict().keys() == set(frame.columns)
    assert {r.text for r in rows} == set(made[::2])


@pytest.mark.parametrize("words, same, numbers", [(13, 12, (11342, 30169)), (94, 84, (29474, 31715))])
def test_the_stage_drops_copies_that_share_no_band(spark, docs, words, same, numbers):
    """Pairs at a similarity of 0.8, found by trying some 30,000 for each size, that no MinHash band proposes."""
    import corpus_pipeline

    made = []
    for k in numbers:
        base = [f"w{k}x{i}" for i in range(words)]
        copy = base[:same] + [f"v{k}x{i}" for i in range(same, words)]
        made += [" ".join(base), " ".join(copy)]
        assert similarity(grams(made[-2]), grams(made[-1])) == 0.8
        assert not set(jaccard.band_keys(jaccard.shingles(made[-2]))) & set(jaccard.band_keys(jaccard.shingles(made[-1])))
    rows = corpus_pipeline.near(spark, docs(made), "").collect()
    assert sorted(r.doc_id for r in rows) == [0, 2]


@pytest.mark.parametrize("sampled, frequent, most, tile", [(1, 2, 1 << 16, 5), (1, 2, 50, 1024), (16, 4, 1 << 16, 3)])
def test_first_shingles_propose_all_pairs_without_bands(spark, docs, texts, monkeypatch, sampled, frequent, most, tile):
    for name, value in (("SAMPLED", sampled), ("FREQUENT", frequent), ("MOST_FREQUENT", most), ("TILE", tile)):
        monkeypatch.setattr(jaccard, name, value)
    monkeypatch.setattr(jaccard, "_band_links", lambda rows, nodes: spark.createDataFrame([], "a long, b long"))
    # two texts of little but what many texts hold
    passage = " ".join(RNG.choices(VOCABULARY, k=60))
    made = [*texts, *(f"{passage} {text}" for text in texts[6:30]), passage, passage + " end"]
    found = {r.row.id: r.component_id for r in jaccard.near_groups(docs(made)).collect()}
    sets, group = [grams(t) for t in made], list(range(len(made)))
    for i in range(len(made)):
        for j in range(i):
            if group[i] != group[j] and similarity(sets[i], sets[j]) >= 0.8:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    assert found == dict(enumerate(group))


def test_similar_sets_share_a_shingle_of_their_prefixes():
    rng = np.random.default_rng(9)
    for n in (1, 4, 5, 9, 10, 45, 90, 900) * 20:
        both = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        x, y = np.unique(both[:n]), np.unique(both[n // 9 : n + n // 9])
        for frequent in (np.zeros(0, np.uint64), np.sort(rng.choice(both, n, replace=False))):
            p, q = jaccard.prefix(x, frequent), jaccard.prefix(y, frequent)
            assert len(p) == len(x) // 5 + 1 and set(p) & set(q)
            # the places of the first that both have leave room for all that both have
            s = next(v for v in p.tolist() if v in set(q.tolist()))
            assert min(len(x) - p.tolist().index(s), len(y) - q.tolist().index(s)) >= len(np.intersect1d(x, y))


def test_bands_share_a_key_as_often_as_said():
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(400):
        both = rng.integers(0, 1 << 63, 180, dtype=np.uint64)
        met += bool(set(jaccard.band_keys(both)) & set(jaccard.band_keys(np.concatenate([both[:144], rng.integers(0, 1 << 63, 36, dtype=np.uint64)]))))
    assert met / 400 > 1 - (1 - (144 / 216) ** 5) ** 24 - 0.05


def test_marks_and_parities_let_similar_sets_pass():
    rng = np.random.default_rng(5)
    unlike = []
    for n in (9, 90, 900) * 200:
        both = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        # n / 9 * 8 hashes of each set are in both: a similarity of 0.8
        x, y = np.unique(both[:n]), np.unique(both[n // 9 : n + n // 9])
        apart = len(np.setxor1d(x, y))
        assert 9 * apart <= len(x) + len(y)
        p, q = sorted((jaccard.parities(x), jaccard.parities(y)), key=len)
        q = q if len(p) == len(q) else q[: len(p)] ^ q[len(p) :]
        assert sum(int(v).bit_count() for v in (p ^ q).view(np.uint64)) <= apart
        first, second = jaccard.marks(jaccard.smallest(x)), jaccard.marks(jaccard.smallest(y))
        digits = [(a >> 4 * k & 15, b >> 4 * k & 15) for a, b in zip(first, second) for k in range(jaccard.MARKS)]
        assert len(digits) == jaccard.BANDS * jaccard.ROWS
        unlike.append(sum(a != b for a, b in digits))
    assert max(unlike) <= jaccard.UNLIKE and abs(np.mean(unlike) - 22.5) < 1


def test_of_many_unlike_sets_in_a_bucket_few_pairs_come_out(spark):
    """Folded parities go into a bucket: pairs at 0.6 to 0.7 do not come out of it, pairs at 0.8 do."""
    rng = np.random.default_rng(8)
    met = {}
    for n in (30, 150, 600, 2400):
        for least, most in ((0.8, 0.82), (0.6, 0.7)):
            rows = []
            for _ in range(60):
                apart = round(n * (1 - (s := rng.uniform(least, most))) / (1 + s))
                base = rng.integers(0, 1 << 63, n + apart, dtype=np.uint64)
                apart = int(n * (1 - s) / (1 + s)) if least == 0.8 else apart
                pair = []
                for label, v in enumerate((base[:n], base[apart : n + apart])):
                    numbers = dict(enumerate(jaccard.marks(jaccard.smallest(v))))
                    folded = dict(enumerate(jaccard.parities(v, jaccard.FOLDED).tolist()))
                    pair.append({"label": label, "size": n} | {f"marks{k}": x for k, x in numbers.items()} | {f"folded{k}": x for k, x in folded.items()})
                rows.append(tuple(tuple(x.values()) for x in pair))
            names = ", ".join(f"{name}: {'int' if name == 'size' else 'long'}" for name in pair[0])
            pairs = spark.createDataFrame(rows, f"x struct<{names}>, y struct<{names}>")
            met[n, least] = pairs.filter(jaccard._may_link(jaccard.BANDS * jaccard.ROWS // jaccard.MARKS)).count()
    assert all(met[n, 0.8] == 60 for n in (30, 150, 600, 2400))
    assert met[30, 0.6] <= 6 and met[150, 0.6] <= 6 and met[600, 0.6] <= 30


def test_sets_of_other_sizes_are_folded(spark):
    rng = np.random.default_rng(6)
    rows, pairs = [], []
    for at, n in enumerate((60, 63, 64, 65, 70, 126, 128, 130, 140, 500, 512, 520)):
        for changed in range(0, n // 4):
            base = rng.integers(0, 1 << 63, n + n // 5, dtype=np.uint64)
            x, y = np.unique(base[:n]), np.unique(base[changed : n + n // 5])
            a, b = 1000 * at + 2 * changed, 1000 * at + 2 * changed + 1
            rows += [(k, len(v), v.view(np.int64).tolist(), jaccard.parities(v).tolist()) for k, v in ((a, x), (b, y))]
            both = len(np.intersect1d(x, y))
            pairs.append((a, b, both / (len(x) + len(y) - both) >= 0.8))
    sets = spark.createDataFrame(rows, "fp long, size int, set array<long>, odd array<long>")
    found = jaccard._alike(spark.createDataFrame([p[:2] for p in pairs], "a long, b long"), sets).collect()
    assert {(r.a, r.b) for r in found} == {p[:2] for p in pairs if p[2]} and 0 < len(found) < len(pairs)


def test_a_group_meets_a_second_round_of_pivots_before_all_pairs(spark, monkeypatch):
    """Copies with edits of their own, like the text they come from and mostly less like each other: what pivots link is not compared again."""
    rng, tried, alike = np.random.default_rng(2), [], jaccard._alike
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(160):
        words = list(base)
        for at in rng.choice(150, 3, replace=False):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(jaccard, "_alike", lambda pairs, sets: tried.append(pairs.count()) or alike(pairs, sets))
    kept = jaccard.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sets, label = [grams(text) for _, text in rows], list(range(160))
    for i in range(160):
        for j in range(i):
            if label[i] != label[j] and similarity(sets[i], sets[j]) >= 0.8:
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    assert sorted(row.doc_id for row in kept) == sorted(set(label))
    assert len(tried) >= 3


def test_few_jobs_for_components(spark):
    """Stars are seen to be done in one round, and totals come with the tables that are written anyway."""
    edges = spark.createDataFrame([(n, n % 3) for n in range(3, 60)], "a long, b long")
    context = spark.sparkContext
    context.setJobGroup("components", "stars")
    try:
        found = {r["fp"]: r["label"] for r in components(edges).collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert found == {n: n % 3 for n in range(60)}
    assert len(context.statusTracker().getJobIdsForGroup("components")) <= 30  # 44 when totals and states were counted apart


def test_measured(spark):
    rows = spark.createDataFrame([(1, 2.5), (2, None)], "a long, b double")
    staged, found = measured(rows, F.count("*").alias("n"), F.sum(F.col("a").cast("decimal(38,0)")).alias("total"))
    assert sorted(staged.collect()) == sorted(rows.collect()) and found == {"n": 2, "total": 3}
    staged, found = measured(rows.filter("a > 5").distinct(), F.count("*").alias("n"), F.sum("a").alias("total"))
    assert staged.collect() == [] and found == {"n": 0, "total": None}
