"""Repeated strings against a brute-force search."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from hiatus.llm.repeats import cut_spans, remove_repeats


def brute(texts, length):
    """(kept, removed, runs) of each text."""
    data = [(x or "").encode() for x in texts]
    seen = Counter(x[i : i + length] for x in data for i in range(len(x) - length + 1))
    out = []
    for x in data:
        gone = np.zeros(len(x) + 2, dtype=bool)
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        kept = bytes(b for b, g in zip(x, gone[1:-1]) if not g)
        out.append((kept, int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum())))
    return out


def found(spark, texts, length, parts=3):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string").repartition(parts)
    rows = {r.doc_id: r for r in remove_repeats(frame, length=length).collect()}
    assert len(rows) == len(texts)
    return [(bytes(rows[i].kept), rows[i].n_removed, rows[i].n_spans) for i in range(len(texts))]


def mixed_texts(seed, count, alphabet, passages):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9)))
    shared = [" ".join(word() for _ in range(rng.randint(5, 90))) for _ in range(passages)]
    texts = []
    for _ in range(count):
        parts = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.5:
                part = rng.choice(shared)
                cut = rng.randint(0, len(part))
                parts.append(part[cut:] if rng.random() < 0.3 else part[:cut] if rng.random() < 0.3 else part)
            else:
                parts.append(" ".join(word() for _ in range(rng.randint(0, 80))))
        texts.append(rng.choice([" ", "", "\n"]).join(parts))
        if texts and rng.random() < 0.2:
            near = list(rng.choice(texts))
            for _ in range(rng.randint(0, 3)):
                if near:
                    near[rng.randrange(len(near))] = rng.choice(alphabet)
            texts.append("".join(near))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force_at_200_bytes(spark, seed):
    texts = mixed_texts(seed, 60, "abcdefghijklmnopqrstuvwxyzé語", 8)
    assert found(spark, texts, 200) == brute(texts, 200)


def test_matches_brute_force_on_a_tiny_alphabet(spark):
    texts = mixed_texts(5, 40, "ab", 5) + ["a" * 700, "ab" * 300, "a" * 199, "a" * 200]
    assert found(spark, texts, 200) == brute(texts, 200)
    assert found(spark, texts, 40) == brute(texts, 40)


def test_a_passage_in_many_different_surroundings(spark):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(260))
    noise = lambda n: "".join(rng.choice("ijklmnop ") for _ in range(n))
    texts = [noise(rng.randint(0, 300)) + passage[: rng.randint(150, 260)] + noise(rng.randint(0, 300)) for _ in range(80)]
    assert found(spark, texts, 200) == brute(texts, 200)


def test_periodic_passages_in_other_surroundings(spark):
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("ijklmnop ") for _ in range(n))
    texts = [noise(rng.randint(0, 90)) + "abcdefg"[:period] * (400 // period) + noise(rng.randint(0, 90)) for period in range(1, 8) for _ in range(4)]
    assert found(spark, texts, 200) == brute(texts, 200)
    assert found(spark, texts, 60) == brute(texts, 60)


def test_whole_characters_are_judged_piece_by_piece(spark):
    passage = "".join(chr(97 + i * i % 23) for i in range(300))
    texts = ["1©" + passage + "éx", "2é" + passage + "èy"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = remove_repeats(frame, whole_characters=True).orderBy("doc_id").collect()
    assert [bytes(r.kept).decode() for r in rows] == ["1x", "2y"]


def test_nulls_empty_texts_and_copies(spark):
    long = "".join(chr(97 + i * i % 23) for i in range(5000)) * 3
    texts = [None, "", "short", "x" * 200, long, long[7:], "short"]
    assert found(spark, texts, 200) == brute(texts, 200)


def test_texts_longer_than_a_stretch(spark):
    rng = np.random.default_rng(1)
    body = bytes(rng.integers(97, 123, 1_200_000, dtype=np.uint8)).decode()
    texts = [body, "zz" + body[524_000:525_000], body[1_199_700:] + "q" * 90]
    got = found(spark, texts, 200)
    assert [x[1:] for x in got] == [(1300, 2), (1000, 1), (300, 1)]


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, kept string, _key int")
    assert remove_repeats(frame).count() == 0
    frame = spark.createDataFrame([(1, "a" * 300, "k", 5)], "doc_id long, text string, kept string, _key int")
    row = remove_repeats(frame).first()
    assert (row._key, bytes(row.kept), row.n_removed, row.n_spans) == (5, b"", 300, 1)


def test_spans_merge_when_they_touch():
    assert cut_spans(b"0123456789", np.array([6, 0, 2]), np.array([8, 2, 4])) == ([b"", b"45", b"89"], 2)
