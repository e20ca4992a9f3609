"""Conversation repair against an exhaustive search."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

from conftest import TEST_TABLES
from hiatus.llm.conversations import damaged, repair, repair_report
from hiatus.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def by_search(rows):
    """Report of one conversation's (turn, role, text), by uniform-cost search over whole edits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        said = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", text)
        if not said:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append(None if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    heap, best = [(0, "", 0, "", ())], None
    visited = set()
    while heap:
        cost, audit, read, initials, kept = heapq.heappop(heap)
        if read == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            best = (cost, audit, kept)
            break
        if not re.fullmatch("s?(ua)*u?", initials) or (audit, initials) in visited:
            continue
        visited.add((audit, initials))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 5, audit + "I", read, initials + role[0], (*kept, f"{role}:")))
        if read < len(rows):
            _, role, text = rows[read]
            heapq.heappush(heap, (cost + 2, audit + "D", read + 1, initials, kept))
            if faults[read] not in ("blank", "duplicate"):
                more = 5 if faults[read] else 0
                heapq.heappush(heap, (cost + more, audit + "K", read + 1, initials + (role[:1] or "-"), (*kept, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    heapq.heappush(heap, (cost + more + 1, audit + "R", read + 1, initials + other[0], (*kept, f"{other}:{text}")))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, kept = best
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def reports(frame):
    found = {}
    for row in frame.collect():
        assert row.conv_id not in found
        found[row.conv_id] = tuple(row)[1:]
    return found


def test_random_conversations_against_the_search(spark):
    draw = random.Random(5)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "cut off", " ", "", None, "Why? ", "été", "Yes.", "x.\n"]
    rows = []
    for conv in range(160):
        for turn in range(draw.randrange(1, 6)):
            rows.append((conv, draw.choice([turn, turn, turn, turn + 3, None, 1]), draw.choice(roles), draw.choice(texts)))
    rows += [(None, 0, "user", "Null ids talk."), (None, 1, "assistant", "They do.")]
    found = reports(repair_report(repair(spark.createDataFrame(rows, SCHEMA))))
    assert set(found) == {r[0] for r in rows}
    for conv, report in found.items():
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        assert report == by_search(own), own


def test_query_on_the_test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TEST_TABLES}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = reports(QUERIES["op12_conversation_repair"](spark, TEST_TABLES))
    hurt = damage(rows)
    assert set(found) == {r[0] for r in rows}
    for conv, report in found.items():
        own = [(t, r, x) for c, t, r, x in hurt if c == conv]
        assert report == by_search(own)


def test_damage_of_nulls_and_repeated_rows(spark):
    draw = random.Random(8)
    rows = [(draw.choice([None, 1, 2]), draw.choice([None, *range(60)]), draw.choice([None, "system"]), draw.choice([None, "A. B? C!"])) for _ in range(400)]
    found = damaged(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", copy string")).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(damage(rows), key=repr)


def test_edits_are_rows_in_order(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 4, "assistant", "It ends.")]
    rows += [(2, 0, "user", "Cut"), (2, 1, "assistant", "Fine."), (2, 2, "user", "Go on."), (2, 3, "assistant", "Well, cut")]
    edits = repair(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "place").collect()
    assert [(e.edit, e.fault) for e in edits] == [
        ("delete", None), ("keep", None), ("delete", "duplicate"), ("keep", None),
        ("delete", "truncated"), ("rerole", None), ("rerole", None), ("delete", "truncated"),
    ]
    assert [(e.role, e.text) for e in edits if e.role] == [
        ("user", "Hi."), ("assistant", "It ends."), ("user", "Fine."), ("assistant", "Go on."),
    ]


def test_one_long_conversation_and_very_long_texts(spark):
    long = "word " * 200_000 + "end."
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(30_001)] + [(2, 0, "user", long), (2, 1, "assistant", long)]
    found = reports(repair_report(repair(spark.createDataFrame(rows, SCHEMA))))
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = found[1]
    assert (gaps, blank, duplicate, truncated, illegal, cost) == (0, 0, 0, 0, 0, 2)
    assert audit == "K" * 30_000 + "D"
    assert found[2][6] == "KK"


def test_no_rows_and_nothing_left(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_report(repair(empty)).collect() == []
    only = spark.createDataFrame([(3, None, None, None)], SCHEMA)
    assert reports(repair_report(repair(only))) == {3: (0, 1, 0, 0, 0, 2, "D", hashlib.sha256(b"").hexdigest())}
