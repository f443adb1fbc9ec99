"""Whole licences, headers, and each place of a notice."""

from __future__ import annotations

import random

from hybridframe.llm import licenses

FILLER = " ".join(f"w{k}" for k in range(400))


def test_every_template_is_found_whole_and_with_a_few_words_changed(spark, docs):
    texts = licenses.templates()
    assert {"GPL-3-text", "MIT-text", "BSD-2-Clause-text", "MPL-2.0-text", "ISC-text", "AGPL-3.0-header"} <= set(texts)
    changed = []
    for text in texts.values():
        words = text.split()
        if len(words) > 60:
            words[30] = words[50] = "changed"
        changed.append(" ".join(["before", *words, "after"]))
    rows = licenses.scan(docs([*texts.values(), *changed])).collect()
    found = {r.row.id: [x.license for x in r.found] for r in rows}
    for k, name in enumerate([*texts, *texts]):
        assert name in found[k], (name, found[k])
    whole = {r.row.id: {x.license: x.coverage for x in r.found} for r in rows}
    assert all(whole[k][name] == 1 for k, name in enumerate(texts))


def test_all_places_of_a_notice_are_returned(docs):
    notice = licenses.NOTICES["MIT-permission"]
    (row,) = licenses.scan(docs([f"{notice} {FILLER} {notice.replace('charge', 'cost')} {notice}"])).collect()
    size = len(licenses.words_of(notice))
    assert [(x.first_word, x.last_word) for x in row.found[0].spans] == [(0, size - 1), (size + 400, 2 * size + 399), (2 * size + 400, 3 * size + 399)]
    assert [x.coverage == 1 for x in row.found[0].spans] == [True, False, True]


def test_anchors_count_positions():
    # one of 40 distinct words fills 60 of 100 positions, and ten other words are missing
    notice = ["the"] * 60 + [f"n{k}" for k in range(40)]
    text = ["the"] * 60 + [f"n{k}" for k in range(10, 40)]
    assert [x[0] for x in licenses.find(text, notice)] == [90]


def common(a, b):
    """Length of the longest common subsequence, by the whole table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_alignment_of_unique_words_is_the_longest_common_subsequence():
    rng = random.Random(41)
    for _ in range(300):
        size = rng.randint(1, 14)
        notice = [f"n{k}" for k in range(size)]
        text = rng.sample(notice, rng.randint(0, size)) + [f"f{k}" for k in range(rng.randint(0, 6))]
        rng.shuffle(text)
        assert len(licenses.align(text, notice)) == common(text, notice)


def test_places_against_all_windows():
    """A notice with words changed, left out, put in and exchanged, somewhere in other words: found exactly where some window has enough of it."""
    rng, outcomes = random.Random(42), []
    for _ in range(250):
        size = rng.randint(8, 30)
        notice = [f"n{k}" for k in range(size)]
        own = list(notice)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(own))
            kind = rng.choice(["change", "drop", "insert", "swap"])
            if kind == "change":
                own[at] = f"x{rng.randrange(9)}"
            elif kind == "drop" and len(own) > 1:
                own.pop(at)
            elif kind == "insert":
                own.insert(at, f"y{rng.randrange(9)}")
            else:
                other = rng.randrange(len(own))
                own[at], own[other] = own[other], own[at]
        before, after = ([f"w{rng.randrange(50)}" for _ in range(rng.randint(0, 60))] for _ in range(2))
        words = [*before, *own, *after]
        need = licenses.least(notice)
        best = max(common(words[start : start + 2 * size], notice) for start in range(len(words)))
        found = licenses.find(words, notice)
        outcomes.append(bool(found))
        assert [place[0] for place in found] == ([best] if best >= need else [])
        assert all(len(before) <= a <= b < len(before) + len(own) for _, a, b in found)
    assert 0.2 < sum(outcomes) / len(outcomes) < 0.8
