"""License scans against a search word by word."""

from __future__ import annotations

import random
import re
import time

from hiatus.llm.licenses import NOTICES, PHRASES, scan_licenses


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text):
    found = words(text)
    places = [
        (i, label)
        for label, phrase in PHRASES
        for i in range(len(found))
        if found[i : i + len(phrase.split(" "))] == phrase.split(" ")
    ]
    starts = [i for i, _ in places]
    return (
        len(found),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({x for _, x in places})),
    )


def texts(seed, count):
    rng = random.Random(seed)
    bits = [p for _, p in PHRASES] + ["Under The MIT", "cc", "by", "nc", "CC BY-NC 4.0.", "license, Version 2.0", "Apache", "é", "K", "mit license"]
    noise = ["wort", "ünder", "the", "a1", "\x7f", "--", "\n", "License"]
    return ["".join(rng.choice(bits + noise) + rng.choice([" ", ", ", "-", "\x00"]) for _ in range(rng.randint(0, 40))) for _ in range(count)]


def scan(spark, rows):
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    return {r.doc_id: r for r in scan_licenses(frame).collect()}


def test_phrases_match_a_word_search(spark):
    rows = texts(1, 200) + [None, "", "the", "under the", "cc by nc", "CC-BY-NC CC-BY-NC cc by nc", "K cc by Knc"]
    found = scan(spark, rows)
    for i, text in enumerate(rows):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_notices_are_found_whole_changed_and_not_in_pieces(spark):
    label, notice = next((a, b) for a, b in NOTICES if a == "bsd")
    parts = notice.split(" ")
    changed = parts[:6] + ["extra"] + parts[6:15] + ["other"] + parts[16:]
    rows = [
        "intro words " + notice.upper() + " tail",
        "x " * 50 + " ".join(changed),
        " ".join(parts[:8]),
        " filler ".join(" ".join(parts[i : i + 4]) + " y" * 40 for i in range(0, len(parts), 4)),
        "This work is licensed under the GNU General Public License, version 3.",
        "the license of a general kind, version 3",
    ]
    found = scan(spark, rows)
    assert [found[i].labels for i in range(6)] == [label, label, "", "", "gpl-3", ""]
    assert found[0].score == 1.0 and 0.8 <= found[1].score < 1 and found[2].score == 0
    place = found[0].places[0]
    assert (place.label, place.start, place.end) == ("bsd", 2, 2 + len(parts))


def test_repeated_rows_nulls_clashing_names_and_empty_table(spark):
    frame = spark.createDataFrame(
        [(1, "cc by nc", "a", 9), (1, "cc by nc", "a", 9), (None, None, None, None)],
        "doc_id long, text string, labels string, pos int",
    )
    rows = sorted(((r.doc_id, r.pos, r.n_words, r.n_base, r.labels) for r in scan_licenses(frame).collect()), key=repr)
    assert rows == [(1, 9, 3, 1, "cc-by-nc"), (1, 9, 3, 1, "cc-by-nc"), (None, None, 0, 0, "")]
    assert scan_licenses(frame.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "cc by nc")], "doc_id long, text string")
    plan = scan_licenses(frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_very_long_texts_take_time_in_proportion(spark):
    def seconds(words):
        text = "some words of no license " * (words // 5 - 10) + "Under the MIT license"
        frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
        started = time.perf_counter()
        row = scan_licenses(frame).first()
        assert (row.n_base, row.first_word, row.base_labels) == (1, (words // 5 - 10) * 5, "mit")
        return time.perf_counter() - started

    seconds(5_000)
    short, long = seconds(80_000), seconds(320_000)
    assert long < 4.5 * max(short, 1.0)
