"""Line deduplication against a plain reading of the rule."""

from __future__ import annotations

import hashlib
import random

from hybridframe.llm import lines

SMALL = {c: c + 32 for c in range(65, 91)}
COMMON = "  This line stands in many documents \t"


def brute_force(rows, least=20, most=3):
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate(SMALL) for line in (text or "").split("\n")] for _, text in rows]
    holders = {}
    for number, own in enumerate(keys):
        for key in set(own):
            if len(key) >= least:
                holders.setdefault(key, []).append(number)
    order = lambda number: (rows[number][0] is not None, rows[number][0] or 0)
    last = {key: max(map(order, own)) for key, own in holders.items() if len(own) >= most}
    return keys, holders, last, order


def check(found, rows):
    """Compare; of rows that repeat the last id any one may keep a line."""
    keys, holders, last, order = brute_force(rows)
    assert len(found) == len(rows)
    by_text = {}
    for r in found:
        by_text.setdefault((r.row.id, r.row.text), []).append(r)
    keeping = dict.fromkeys(last, 0)
    for number, (i, text) in enumerate(rows):
        r = by_text[i, text].pop()
        own, parts = keys[number], (text or "").split("\n")
        single = [sum(order(n) == last[key] for n in holders[key]) == 1 if key in last else True for key in own]
        assert r.n_lines == len(parts)
        if all(single):
            kept = [part for part, key in zip(parts, own) if key not in last or last[key] == order(number)]
            assert r.kept == "\n".join(kept) and r.n_dropped == len(parts) - len(kept)
        for key in set(own) & set(last):
            left = [line for line in r.kept.split("\n") if line.strip(" \t\n\x0b\x0c\r").translate(SMALL) == key]
            assert len(left) in (0, own.count(key))
            keeping[key] += bool(left)
    assert set(keeping.values()) <= {1}


def test_lines(docs):
    rng = random.Random(3)
    pool = [f"line number {i} of the pool of lines" for i in range(30)] + ["short", "", " ", "é" * 19, "É" * 20, "é" * 20, COMMON, COMMON.upper(), COMMON.strip()]
    texts = ["\n".join(rng.choices(pool, k=rng.randint(1, 25))) for _ in range(60)]
    texts += [None, "", "\n", "\n\n", "no line of others is here at all", COMMON, COMMON + "\n" + COMMON, "\n".join([COMMON, "x"] * 3000), "tail\n", "\r\n" + COMMON + "\r\n"]
    rows = list(zip([*range(len(texts) - 4), 7, 7, None, None], texts))
    frame = docs([t for _, t in rows], [i for i, _ in rows])
    check(lines.drop_common_lines(frame, carry=["text", "n"]).collect(), rows)


def test_a_line_in_two_documents_stays_and_the_last_holder_keeps_all_its_lines(docs):
    line = "exactly twenty signs"
    two = lines.drop_common_lines(docs([line, line, "other"])).collect()
    assert [r.n_dropped for r in two] == [0, 0, 0]
    # in one document many times is one document
    one = lines.drop_common_lines(docs([f"{line}\n{line}\n{line}", line, "other"])).collect()
    assert [r.n_dropped for r in one] == [0, 0, 0]
    three = {r.row.id: r for r in lines.drop_common_lines(docs([f"a\n{line}\nb", line, f"{line}\n{line.upper()} "], [5, 1, 9])).collect()}
    assert (three[5].kept, three[1].kept, three[9].kept) == ("a\nb", "", f"{line}\n{line.upper()} ")
    assert (three[1].n_lines, three[1].n_dropped) == (1, 1)


def test_empty_table(docs):
    assert lines.drop_common_lines(docs(["a"]).limit(0)).count() == 0


def test_query(spark):
    rows = lines.op12(spark, "/root/testdata/sf0.001")
    assert dict(rows.dtypes) == {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"}
    first = rows.filter("n_dropped = 0").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(f"doc_id = {first.doc_id}").first().text
    assert first.kept_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
