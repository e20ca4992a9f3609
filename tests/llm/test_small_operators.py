"""Decontamination, mixing and toxicity on odd rows."""

from __future__ import annotations

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from hiatus.llm.decontamination import contamination, filter_of, hit_words, word_hashes
from hiatus.llm.mixing import copies, mix, poisson
from hiatus.llm.toxicity import toxicity


def test_contamination_of_odd_rows_with_small_filters(spark):
    item = " ".join(f"w{i}" for i in range(12))
    benchmark = spark.createDataFrame(
        [(1, item), (1, item), (2, "Short One"), (3, None), (None, "nameless"), (4, "")], "item_id long, text string"
    )
    documents = spark.createDataFrame(
        [(1, "x " + item.upper().replace(" ", ", ") + " y", "a"), (2, None, None), (2, "", "b"), (3, "short-one short one", "c"),
         (4, " ".join(f"w{i}" for i in range(9)), "d"), (5, "a nameless text", "e")],
        "doc_id long, text string, items string",
    )
    for bits in (1 << 20, 64):
        rows = contamination(documents, benchmark, filter_bits=bits).withColumn("n_hit", hit_words()).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in rows) == [
            (1, 14, 12, ["1"]), (2, 0, 0, []), (2, 0, 0, []), (3, 4, 4, ["2"]), (4, 9, 0, []), (5, 3, 1, [""])
        ]
    assert contamination(documents.limit(0), benchmark).count() == 0
    assert contamination(documents, benchmark.limit(0)).where(F.size("spans") > 0).count() == 0


def test_contamination_of_frequent_words_against_brute_force(spark):
    draw = random.Random(3)

    def prose(count):
        return " ".join(draw.choices(["a", "b", "C", "dé", "e"], k=count))

    texts = [prose(draw.randint(0, 60)) for _ in range(80)]
    items = [prose(n) for n in (1, 2, 3, 4, 5, 6, 7, 40)] + [texts[5], texts[6] + " " + texts[7], "", None, "zz a b"]
    texts += [f"x {items[7]}; {prose(3)}"] * 4 + [prose(30_000), "a" * 100_000 + " " + items[7], "", None]
    size = 6

    def cut(text):
        return re.findall("[a-z0-9\x80-\U0010ffff]+", (text or "").lower())

    windows = {}
    for item, text in enumerate(items):
        found = cut(text)
        for i in range(max(1, len(found) - size + 1) if found else 0):
            windows.setdefault(tuple(found[i : i + size]), set()).add(str(item))
    expected = []
    for doc, text in enumerate(texts):
        found, spans, ids = cut(text), set(), set()
        for n in range(1, size + 1):
            for i in range(len(found) - n + 1):
                if tuple(found[i : i + n]) in windows:
                    spans.add((i, i + n))
                    ids |= windows[tuple(found[i : i + n])]
        expected.append((doc, len(found), sorted(spans), sorted(ids)))
    documents = spark.createDataFrame(list(enumerate(texts)), "_digest int, text string").repartition(5)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    for bits in (1 << 24, 64):
        rows = contamination(documents, benchmark, size=size, filter_bits=bits).collect()
        assert sorted((r["_digest"], r.n_words, [tuple(s) for s in r.spans], r["items"]) for r in rows) == expected


def test_words_hash_alike_wherever_they_stand():
    draw = random.Random(9)
    found = [draw.randbytes(draw.randint(1, 12)).hex().encode() for _ in range(150_000)]
    found += found[:50] + [b"x" * 2_000_000, b"y"] + found[-50:]
    cleaned = b"  " + b" ".join(found) + b" "
    starts, hashed = word_hashes(cleaned)
    assert [cleaned[s : s + len(w)] for s, w in zip(starts.tolist(), found, strict=True)] == found
    assert len({*zip(found, hashed.tolist(), strict=True)}) == len(set(found)) == len(set(hashed.tolist()))
    assert [len(part) for part in word_hashes(b" ")] == [len(part) for part in word_hashes(b"")] == [0, 0]


def test_filter_holds_all_and_little_else(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 40_000)
    held, others = values[:30_000], values[30_000:]
    frame = spark.createDataFrame([(int(v),) for v in held], "value long")
    assert filter_of(frame).has(held).all() and filter_of(frame).has(others).mean() < 0.05
    assert filter_of(frame, 1 << 12).has(held).all()
    assert not filter_of(frame.limit(0)).has(others).any()


def test_poisson_inverse_matches_the_sums(spark):
    cases = [(rate, unit) for rate in (0.01, 0.7, 3.0, 80.0) for unit in (0.0005, 0.3, 0.5, 0.9, 0.9995)]
    frame = spark.createDataFrame(cases, "rate double, unit double")
    for row in frame.withColumn("n", poisson(F.col("rate"), F.col("unit"))).collect():
        p = total = math.exp(-row.rate)
        n = 0
        while total < row.unit:
            n += 1
            p *= row.rate / n
            total += p
        assert row.n == n


def test_mixture_reaches_its_weights(spark):
    rows = [(i, "x" * 100, "big" if i % 10 else None, i) for i in range(4000)] + [(None, None, "none", 1), (1, "", "none", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int")
    mixed = mix(frame)
    shares = {r.source: r.n for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(shares["big"] / 2000 - 1) < 0.1 and abs(shares[None] / 2000 - 1) < 0.15
    only = mix(frame, {"big": 1.0}).select("source").distinct().collect()
    assert [r.source for r in only] == ["big"]
    assert mix(frame.limit(0)).count() == 0


def test_null_and_repeated_ids_have_draws_of_their_own(spark):
    """A third null ids, a third one id, a third exact copies: all reach their weights, in even tasks."""
    rows = [(None, f"t{i}", "a", "x") for i in range(6000)] + [(7, f"u{i}", "b", "x") for i in range(6000)]
    rows += [(8, "same text", "c", "x")] * 6000
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, _number string").repartition(5)
    mixed = mix(frame).cache()
    sizes = {s: sum(len(r[1]) for r in rows if r[2] == s) for s in "abc"}
    for row in mixed.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("mix_key").alias("keys")).collect():
        mean = 6000 * sum(sizes.values()) / 3 / sizes[row.source]
        assert abs(row.n - mean) < 3.5 * math.sqrt(mean)
        assert row["keys"] == row.n
    per_task = [r.n for r in mixed.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(per_task) < 2 * sum(per_task) / len(per_task)
    assert mixed.where("source = 'a'").select("text").distinct().count() > 3000
    again = mix(frame.repartition(3)).agg(F.bit_xor(F.xxhash64("doc_id", "text", "copy", "mix_key"))).first()
    assert mixed.agg(F.bit_xor(F.xxhash64("doc_id", "text", "copy", "mix_key"))).first() == again
    mixed.unpersist()


def test_large_rates_keep_their_variance(spark):
    drawn = spark.range(3000).select(copies(F.lit(2000.0), F.lit(3), F.col("id")).alias("n"))
    mean, variance = drawn.agg(F.avg("n"), F.variance("n")).first()
    assert abs(mean - 2000) < 4 * math.sqrt(2000 / 3000)
    assert abs(variance / 2000 - 1) < 0.12


def test_toxicity_learns_and_takes_odd_rows(spark):
    words = "the house stands near a river with old trees and stones".split()
    texts = [" ".join(words[(i * k) % 11] for k in range(1, 30)) + (" vile nasty" if i % 3 == 0 else "") for i in range(300)]
    frame = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, p_toxic string")
    labels = spark.createDataFrame([(i, int(i % 2), int(i % 3 == 0)) for i in range(200)] + [(None, 1, 1), (5, None, None)], "doc_id long, other int, toxic int")
    odd = spark.createDataFrame([(None, None, None), (900, "", None), (901, "a NASTY, vile house", None), (901, "a NASTY, vile house", None)], frame.schema)
    found = toxicity(frame.union(odd), labels, ("other", "toxic")).collect()
    assert len(found) == 304
    assert all(r.rejected == (r.doc_id % 3 == 0) for r in found if r.doc_id is not None and r.doc_id < 300)
    assert [r.rejected for r in found if r.doc_id == 901] == [True, True]
    assert not any(r.rejected for r in toxicity(frame, labels.limit(0), ("toxic",)).collect())
    assert toxicity(frame.limit(0), labels, ("toxic",)).count() == 0
