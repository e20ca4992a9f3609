"""The trie of conversations against one of dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from conftest import TEST_TABLES
from hiatus.llm.prefix_trie import prefix_trie, spliced, turn_sequences
from hiatus.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, turns string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=order)] for c, turns in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return made


def order(turn):
    known, number, role, text = turn
    return known, number, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(sequences):
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(set)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].add(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        size = len(prefix[-1][1].encode()) if prefix else 0
        leaves[prefix] = sum(leaves[x] for x in children[prefix]) or 1
        saved[prefix] = (len(members[prefix]) - 1) * size + sum(saved[x] for x in children[prefix])
    rows = []
    for prefix, convs in members.items():
        ends = sorted(c for c in convs if len(sequences[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        joined = ",".join(map(str, ends)).encode()
        rows.append((min(convs), len(prefix), parent, len(convs), len(children[prefix]), leaves[prefix], saved[prefix], hashlib.sha256(joined).hexdigest()))
    return sorted(rows, key=repr)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def found(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=repr)


def random_rows(seed, convs=300):
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(draw.choice([1, 2, 3, 5, 8, 40])):
            said = draw.choice(["yes", "no", "né", None, f"only {c}"]) if draw.random() < 0.2 else "always"
            rows.append((c, draw.choice([turn, turn, None]), draw.choice(["user", "user", None]), said))
    return rows


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_any_number_of_shards(spark, shards):
    rows = random_rows(shards)
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    set_to = {"spark.sql.shuffle.partitions": str(shards), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in set_to}
    try:
        for k, v in set_to.items():
            spark.conf.set(k, v)
        assert found(prefix_trie(spliced(turn_sequences(frame)))) == brute(rebuilt(rows))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_copies_spread_over_shards_and_turnless_members(spark):
    turns = [("u", "same")] * 20
    sequences = {c: turns for c in range(0, 400)} | {c: [] for c in range(400, 430)} | {c: turns[:7] for c in range(500, 600)}
    rows = [(c, [(hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest(), len(t)) for r, t in s]) for c, s in sequences.items()]
    frame = spark.createDataFrame(rows, "conv_id long, turns array<struct<id:string,n_bytes:bigint>>")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert found(prefix_trie(frame)) == brute(sequences)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_long_conversations_nulls_and_very_long_texts(spark):
    long = "w " * 500_000
    rows = [(1, i, "user", f"t{i % 3}") for i in range(2000)] + [(2, i, "user", f"t{i % 3}") for i in range(1500)]
    rows += [(7, 0, "user", long), (8, 0, "user", long), (8, 1, None, None), (None, 0, "user", "no id"), (9, None, None, None), (9, None, None, None)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert found(prefix_trie(spliced(turn_sequences(frame)))) == brute(rebuilt(rows))


def test_no_rows(spark):
    assert prefix_trie(spliced(turn_sequences(spark.createDataFrame([], SCHEMA)))).collect() == []


def test_query_on_the_test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TEST_TABLES}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_prefix_trie"](spark, TEST_TABLES)) == brute(rebuilt(rows))
