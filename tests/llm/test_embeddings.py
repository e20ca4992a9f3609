"""Embedding links against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from hiatus.llm import embeddings, shards
from hiatus.llm.embeddings import encode, near_embeddings, rotations, tables_for, upper_bounds


def brute(vectors):
    """(links, smallest reachable index) of each vector; None links with nothing."""
    n = len(vectors)
    valid = [
        v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors
    ]
    near = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(n):
            if i != j and valid[i] and valid[j] and len(vectors[i]) == len(vectors[j]):
                a, b = (np.array(vectors[k], dtype=np.float64) for k in (i, j))
                near[i, j] = a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([root[j] for j in np.flatnonzero(near[i])] + [root[i]])
            if low < root[i]:
                root[i], changed = low, True
    return near.sum(axis=1), root


def clustered(seed, size, clusters, each):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(clusters):
        centre = rng.standard_normal(size)
        for _ in range(rng.integers(1, each)):
            out.append((centre + rng.standard_normal(size) * rng.choice([0, 0.1, 0.2, 0.3])).astype(np.float32))
    return [v.tolist() for v in out]


def check(spark, vectors):
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>").repartition(4)
    found = {r.vec_id: r for r in near_embeddings(frame).collect()}
    links, root = brute(vectors)
    for i in range(len(vectors)):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (links[i], root[i], root[i] == i)


def test_links_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BUCKET", 8)
    monkeypatch.setattr(shards.in_pieces, "__defaults__", (16,))
    check(spark, clustered(1, 64, 40, 12))


def test_odd_vectors_and_sizes(spark):
    inf, nan = float("inf"), float("nan")
    check(
        spark,
        [None, [], [0.0, 0.0], [1.0, None], [inf, 1.0], [nan, 1.0], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0], [1.0, 2.0, 0.0], [3.0], [5.0], [-1.0], [1e-38, 2e-38], [1e38, 2e38]],
    )


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    units = embeddings._units(rng.standard_normal((300, 64)))
    near = embeddings._units(units[:100] + 0.04 * rng.standard_normal((100, 64)))
    both = np.concatenate([units, near])
    codes, factors = encode(both)
    bound = upper_bounds(codes, factors, both @ rotations(64, 1))
    true = both @ both.T
    assert (bound + 1e-5 >= true).mean() > 0.9999
    assert (bound[true >= 0.95] >= 0.95 - 1e-5).all()
    assert (bound[true < 0.5] >= 0.95).mean() < 0.02


def test_estimates_are_unbiased():
    rng = np.random.default_rng(5)
    units = embeddings._units(rng.standard_normal((400, 64)))
    codes, factors = encode(units)
    turned = units @ rotations(64, 1)
    signs = np.unpackbits(codes, axis=1).astype(float) * 2 - 1
    error = signs @ turned.T / 8 / factors[:, None] - units @ units.T
    assert abs(error[~np.eye(400, dtype=bool)].mean()) < 0.005


@pytest.mark.parametrize("count", [1, 513, 50_000, 10**9])
def test_the_chance_of_a_miss_is_bounded(count):
    bits, tables = tables_for(count, 0.95)
    shared = (1 - np.arccos(0.95) / np.pi) ** bits
    assert (1 - shared) ** tables <= 1e-6 or bits == 0


def test_ties_empty_table_and_extra_columns(spark):
    frame = spark.createDataFrame(
        [(4, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (None, [1.0, 0.0], 3), (None, None, 4)],
        "vec_id long, embedding array<float>, kept int",
    )
    rows = sorted(map(tuple, near_embeddings(frame).collect()), key=repr)
    assert rows == sorted([(4, 2, 4, True), (4, 2, 4, True), (None, 2, 4, False), (None, 0, None, True)], key=repr)
    assert near_embeddings(frame.limit(0)).count() == 0
