"""MinHash fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest

from hiatus.llm.fingerprints import edited_fingerprints, near_duplicates
from hiatus.llm.queries import QUERIES
from conftest import TEST_TABLES

LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))


def expected(rows):
    """(id, n_chars, edited hash) by the definition, on distinct rows in order."""
    order = sorted({(i is not None, i, t or "") for i, t in rows}, key=lambda r: (r[0], r[1] or 0, hashlib.md5(r[2].encode()).hexdigest()))
    facts = {}
    for place, (_, ident, text) in enumerate(order):
        following = order[(place + 1) % len(order)][2]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        facts[ident, text] = (ident, len(text), hashlib.sha256(changed.encode()).hexdigest())
    return sorted((facts[i, t or ""] for i, t in rows), key=repr)


def sets(text):
    words = "".join(c.lower() if c.isascii() else c for c in text).split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def true_jaccard(one, other):
    a, b = sets(one), sets(other)
    return len(a & b) / len(a | b) if a | b else 1.0


def some_rows(seed=3):
    draw = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gämma", "delta", "epsilon", "zeta", "eta", "theta", "日本", "😀"]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randrange(0, 60))) for _ in range(120)]
    rows = list(enumerate(texts))
    rows += [(5, texts[5]), (5, texts[5]), (5, "another text under the same id"), (None, "no id"), (None, "no id")]
    rows += [(500, None), (501, ""), (502, "one"), (503, "one two three four"), (504, LONG), (505, LONG)]
    return rows


@pytest.mark.parametrize("group_bytes", [1, 500, 1 << 25])
def test_every_row_against_its_definition(spark, group_bytes):
    rows = some_rows()
    frame = spark.createDataFrame([(i, t, "x", i) for i, t in rows], "doc_id long, text string, seat string, bucket long")
    found = edited_fingerprints(frame, group_bytes=group_bytes).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=repr) == expected(rows)


def test_likeness_and_equal_texts(spark):
    rows = some_rows()
    found = edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), group_bytes=2000).collect()
    texts = dict((i, t or "") for i, t in rows if i is not None and i != 5)
    by_id = {r.doc_id: r for r in found if r.doc_id in texts}
    assert by_id[504].fingerprint == by_id[505].fingerprint and by_id[504].near_next == 1.0
    assert by_id[504].jaccard_next == 1.0 and by_id[500].fingerprint == by_id[501].fingerprint
    for ident, row in by_id.items():
        assert len(row.fingerprint) == len(row.edited_fingerprint) == 512
        same = [row.fingerprint[i : i + 4] == row.edited_fingerprint[i : i + 4] for i in range(0, 512, 4)]
        assert row.near_edited == sum(same) / 128
        if ident + 1 in texts:
            truth = true_jaccard(texts[ident], texts[ident + 1])
            assert abs(row.near_next - truth) < 0.25
            assert row.jaccard_next is None or abs(row.jaccard_next - truth) < 1e-12
            if truth >= 0.8:
                assert row.jaccard_next is not None


def test_one_document_follows_itself(spark):
    row = edited_fingerprints(spark.createDataFrame([(7, "abcdef")], "doc_id long, text string")).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert edited_fingerprints(empty).collect() == []
    assert near_duplicates(empty).collect() == []


def test_text_ids_and_bytes_beyond_utf8(spark):
    frame = spark.sql("SELECT 'a' AS doc_id, cast(X'61FF62' AS string) AS text UNION ALL SELECT 'b', 'xyz'")
    found = {r.doc_id: r for r in edited_fingerprints(frame).collect()}
    assert found["a"].n_chars == 3
    assert found["a"].edited_sha256 == hashlib.sha256(b"a\xffx").hexdigest()


def test_near_duplicates_against_all_pairs(spark):
    draw = random.Random(9)
    base = [[f"t{draw.randrange(4000)}" for _ in range(120)] for _ in range(25)]
    rows, ident = [], 0
    for words in base:
        for _ in range(6):
            changed = list(words)
            for _ in range(draw.choice([0, 1, 2, 3, 8])):
                changed[draw.randrange(len(changed))] = f"n{draw.randrange(10**6)}"
            rows.append((ident, " ".join(changed)))
            ident += 1
    rows += [(900, rows[0][1]), (901, None), (902, ""), (None, rows[0][1])]
    root = {i: i for i, _ in rows}

    def find(i):
        return i if root[i] == i else find(root[i])

    known = [(i, t or "") for i, t in rows if i is not None]
    for place, (i, a) in enumerate(known):
        for j, b in known[:place]:
            if true_jaccard(a, b) >= 0.8:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.class_id == (find(row.doc_id) if row.doc_id is not None else 0)


def test_query_on_the_test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TEST_TABLES}/documents.parquet").collect()]
    found = QUERIES["op11_minhash"](spark, TEST_TABLES).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=repr) == expected(rows)
