"""What is registered, and the named queries that SQL can say."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import pytest

import check
from hybridframe.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"

# The columns that each query has to return, with their types.
COLUMNS = {
    1: "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    2: "doc_id bigint, fingerprint string, component_id bigint",
    3: "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    4: "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    5: "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    6: "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    7: "doc_id bigint, held_out boolean, lang_pred string, score double",
    8: "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    9: "doc_id bigint",
    10: "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    11: "rank int, doc_id bigint, score bigint",
    12: "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    13: "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}
ONE_ROW_EACH = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def results(spark):
    """Rows and types of every registered query, run once."""
    found = {}

    def of(number: int):
        if number not in found:
            frame = next(run for name, run in QUERIES.items() if name.startswith(f"op{number}_"))(spark, SF_DIR)
            found[number] = dict(frame.dtypes), frame.collect()
        return found[number]

    return of


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    ok, note = check.compare(spark, SF_DIR, name, QUERIES[name], SQL[name])
    assert ok, note


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_columns_types_and_rows(results, texts, number):
    types, rows = results(number)
    assert {name: types.get(name) for name in (c.split()[0] for c in COLUMNS[number].split(", "))} == dict(c.split() for c in COLUMNS[number].split(", "))
    if number in ONE_ROW_EACH:
        assert sorted(r.doc_id for r in rows) == sorted(texts)


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_values_of_queries_without_sql(results, texts):
    """The registered queries against a plain reading of their contracts, over the whole small table."""
    from tokenizers import Tokenizer

    from hybridframe.llm.bpe import default_path
    import xxhash

    sha = lambda data: hashlib.sha256(data).hexdigest()
    shards = results(1)[1]
    for r in shards:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    assert {r.shard for r in shards} <= set(range(8)) and {r.law for r in shards} == {"bytes"}
    for shard in {r.shard for r in shards}:
        assert sorted(r.slot for r in shards if r.shard == shard) == list(range(sum(r.shard == shard for r in shards)))
    by_text = {}
    for r in shards:
        by_text.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(own) == 1 for own in by_text.values())

    prints = {}
    for r in results(2)[1]:
        words = WORD.findall((texts[r.doc_id] or "").translate(SMALL))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        bits = Counter(b for s in shingles for h in [xxhash.xxh64_intdigest(s.encode(), 42)] for b in range(64) if h >> b & 1)
        assert int(r.fingerprint, 16) == sum(1 << b for b, n in bits.items() if 2 * n > len(shingles))
        prints[r.doc_id] = int(r.fingerprint, 16), r.component_id
    reach = {doc: doc for doc in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            least = min(reach[b] for b in prints if (prints[a][0] ^ prints[b][0]).bit_count() <= 2)
            if least < reach[a]:
                reach[a], changed = least, True
    assert {doc: own[1] for doc, own in prints.items()} == reach

    for r in results(3)[1]:
        words = WORD.findall(texts[r.doc_id] or "")
        assert r.base_failed == (len(words) < 10 or 100 * r.n_repeat_words > 20 * len(words)) and (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert not (r.base_failed and r.kept)

    library = Tokenizer.from_file(default_path())
    library.no_truncation()
    library.no_padding()
    counts = {r.doc_id: r for r in results(8)[1]}
    for r in results(6)[1]:
        text = texts[r.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False).encode())
        other = counts[r.doc_id]
        assert (other.n_bytes, other.n_tokens, other.over_limit) == (len(text.encode()), len(ids), len(ids) > 512)

    data = {doc: (text or "").encode() for doc, text in texts.items()}
    seen = Counter()
    for own in data.values():
        seen.update(own[i : i + 200] for i in range(len(own) - 199))
    for r in results(10)[1]:
        own = data[r.doc_id]
        gone = bytearray(len(own))
        for i in range(len(own) - 199):
            if seen[own[i : i + 200]] > 1:
                gone[i : i + 200] = b"\x01" * 200
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(own), sum(gone), spans)
        assert r.kept_sha256 == sha(bytes(c for c, g in zip(own, gone) if not g))


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_license_query_names_every_exact_occurrence(results, texts):
    """A notice that stands in a text word for word is named, unless it is part of a longer one that is; nothing is named without most of its words."""
    from hybridframe.llm import licenses

    wanted = {name: licenses.words_of(text) for name, text in licenses.templates().items()}
    named = 0
    for r in results(9)[1]:
        words = licenses.words_of(texts[r.doc_id] or "")
        joined, found = f" {' '.join(words)} ", set(filter(None, r.licenses.split(",")))
        exact = {name for name, notice in wanted.items() if f" {' '.join(notice)} " in joined}
        longest = {name for name in exact if not any(f" {' '.join(wanted[name])} " in f" {' '.join(wanted[other])} " for other in exact - {name})}
        assert longest <= found and r.n_licenses == len(found) <= r.n_spans or not found
        for name in found:
            assert sum((Counter(words) & Counter(wanted[name])).values()) >= licenses.least(wanted[name])
        named += len(found)
    assert named > 0
