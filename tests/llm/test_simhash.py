"""SimHash groups against a brute-force comparison."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from hiatus.llm import simhash
from hiatus.llm.simhash import fingerprint, links, near_duplicates


def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
             .replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def sentences(seed, count):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    texts = []
    for _ in range(count):
        if texts and rng.random() < 0.4:
            near = rng.choice(texts).split(" ")
            for _ in range(rng.randint(0, 3)):
                near[rng.randrange(len(near))] = rng.choice(words)
            texts.append(" ".join(near))
        else:
            texts.append(" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 4, 40, 300]))))
    return texts


def test_fingerprint_matches_the_definition():
    for text in [*sentences(1, 40), "", "  \t\n", "One TWO three", "É È x\x0by z W", "a b c d", "a b c d e"]:
        assert fingerprint(text.encode()) % (1 << 64) == brute_fingerprint(text)


def test_bit_counts_of_many_hashes():
    hashes = np.random.default_rng(2).integers(0, 1 << 63, 70_000, dtype=np.uint64) | np.uint64(1 << 63)
    expected = [(int((hashes >> np.uint64(b) & np.uint64(1)).sum())) for b in range(64)]
    assert simhash._bit_counts(hashes).tolist() == expected


@pytest.mark.parametrize("seed", range(2))
def test_components_match_brute_force(spark, seed):
    texts = sentences(seed, 250) + [None, "", "   "]
    frame = spark.createDataFrame([(900 - i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in near_duplicates(frame.repartition(5)).collect()}
    prints = [brute_fingerprint(x) for x in texts]
    roots = brute_components(prints)
    for i, x in enumerate(prints):
        row = rows[900 - i]
        assert int(row.fingerprint, 16) == x
        smallest = min(900 - j for j in range(len(texts)) if roots[j] == roots[i])
        assert (row.component_id, row.kept) == (smallest, smallest == row.doc_id)


def test_trees_and_pieces_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.integers(-(1 << 63), 1 << 63, 60, dtype=np.int64)
    near = [c ^ np.int64(sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 6), replace=False))) for c in centres for _ in range(25)]
    prints = np.unique(np.array([*centres, *near], dtype=np.int64))
    from hiatus.llm import shards

    monkeypatch.setattr(shards.in_pieces, "__defaults__", (64,))
    frame = spark.createDataFrame([(int(p),) for p in prints], "fingerprint long")
    from hiatus.llm.components import connected

    found = {r.node: r.root for r in connected(links(frame, 4, leaf=16), "low", "high").collect()}
    roots = brute_components([int(p) for p in prints])
    groups = {}
    for p, r in zip(prints.tolist(), roots):
        groups.setdefault(r, []).append(p)
    for members in groups.values():
        assert {found.get(m, m) for m in members} == {min(members)}


def test_ties_nulls_and_repeated_rows(spark):
    frame = spark.createDataFrame(
        [(3, "a b c d e", "x"), (3, "a b c d e", "y"), (None, "a b c d e", "z"), (None, "other words stand here now", None)],
        "doc_id long, text string, fingerprint string",
    )
    rows = near_duplicates(frame).collect()
    assert sorted(str(r.component_id) for r in rows) == ["3", "3", "3", "None"]
    assert sum(r.kept for r in rows) == 2
    assert near_duplicates(frame.limit(0)).count() == 0
