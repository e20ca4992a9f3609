"""Archives written and read back."""

from __future__ import annotations

import hashlib
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from hiatus.llm import archives
from hiatus.llm.tables import new_path

NESTED = (
    "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
)


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) by the definition."""
    bodies = [(i, (x or "").encode()) for i, x in rows]
    newest = {}
    for i, body in bodies:
        if len(body) >= 1000 and i is not None:
            newest[body] = max(newest.get(body, i), i)
    out = []
    for i, body in bodies:
        refers = newest.get(body)
        revisit = refers is not None and refers != i
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", refers if revisit else None))
    return sorted(out, key=repr)


def read(frame):
    rows = archives.archived(frame).collect()
    as_int = lambda x: None if x is None else int(x)
    return sorted(
        ((as_int(r.id), r.payload_bytes, r.payload_digest, r.type, as_int(r.refers_to)) for r in rows), key=repr
    )


@pytest.fixture
def tiny_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def pages(seed, count):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        kind = rng.random()
        if kind < 0.3 and rows:
            rows.append((i, rng.choice(rows)[1]))
        elif kind < 0.5:
            inside = rng.choice([NESTED, "WARC/1.", "WARC/1.1\r\nContent-Length: 99\r\n\r\n", NESTED + NESTED, "\r\n\r\nWARC/1.0\r\n"])
            rows.append((i, "x" * rng.randint(0, 600) + inside * rng.randint(1, 3) + "é" * rng.randint(0, 400)))
        else:
            rows.append((i, rng.choice([None, "", "kurz", "语" * rng.randint(0, 700), "a\r\n\r\nb" * rng.randint(0, 300)])))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_round_trip_with_magic_in_payloads(spark, tiny_splits, seed):
    rows = pages(seed, 60)
    frame = spark.createDataFrame([(i, f"http://x/{i} é\r\nX: y", x) for i, x in rows], "page_id long, url string, html string")
    assert read(frame.repartition(3)) == expected(rows)


def test_whole_splits(spark):
    rows = pages(7, 40)
    frame = spark.createDataFrame([(i, None, x) for i, x in rows], "page_id long, url string, html string")
    assert read(frame.coalesce(1)) == expected(rows)


def test_a_nested_record_that_ends_where_its_host_ends(spark):
    """The inner header's length reaches exactly the next real record."""
    inner = "WARC/1.1\r\nContent-Length: 9\r\n\r\nabcde"  # its 9 bytes end with the host's own end
    rows = [(1, "p" + inner), (2, "q" * 30), (3, inner)]
    frame = spark.createDataFrame([(i, "u", x) for i, x in rows], "page_id long, url string, html string")
    assert read(frame.coalesce(1)) == expected(rows)


def test_ties_nulls_empty_table_and_clashing_names(spark):
    body = "z" * 1200
    frame = spark.createDataFrame(
        [(5, "u", body, "a"), (5, "u", body, "b"), (2, "u", body, "c"), (None, "u", body, "d"), (None, None, None, None)],
        "page_id long, url string, html string, record_type string",
    )
    got = read(frame)
    assert [x[3] for x in got if x[0] == 5] == ["response", "response"]
    assert [(x[0], x[4]) for x in got if x[3] == "revisit"] == [(2, 5), (None, 5)]
    assert read(frame.limit(0)) == []


def test_offsets_add_up_to_the_file(spark, tiny_splits):
    path = new_path(spark, "one-file")
    frame = spark.createDataFrame([(i, "u", "WARC/1." * i) for i in range(30)], "page_id long, url string, html string")
    archives.write_archives(archives.with_record_types(frame).coalesce(1), path)
    whole = spark.read.format("binaryFile").load(path).select("content").first().content
    rows = archives._placed(archives._scan(spark, path)).collect()
    assert sorted(r.offset for r in rows) == [i + 7 for i in range(len(whole)) if whole[i : i + 7] == b"WARC/1."]
    assert spark.read.text(path).where(F.col("value").startswith("WARC-Type")).count() == 30


def test_magic_in_addresses_and_ids(spark, tiny_splits):
    rows = pages(11, 40)
    addresses = ["http://x/WARC/1.1/spec", "WARC/1.", "u" * 900 + "WARC/1.WARC/1.1\r\n\r\nWARC/1.1", None, "http://x/plain"]
    frame = spark.createDataFrame([(i, addresses[i % 5], x) for i, x in rows], "page_id long, url string, html string")
    assert read(frame.coalesce(1)) == expected(rows)
    assert read(frame.repartition(4)) == expected(rows)
    named = spark.createDataFrame([(f"WARC/1.{i}", "u", x) for i, x in enumerate(["a", None, "b" * 3000])], "page_id string, url string, html string")
    got = sorted((r.id, r.payload_bytes) for r in archives.archived(named).collect())
    assert got == [("WARC/1.0", 1), ("WARC/1.1", 0), ("WARC/1.2", 3000)]


def raw_archive(spark, tmp_path, name, change):
    """An archive of five records as bytes, changed and written as one file."""
    rows = [(i, f"http://x/{i}", c * 500) for i, c in enumerate("abcde")]
    path = new_path(spark, "whole")
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives.write_archives(archives.with_record_types(frame).coalesce(1), path)
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).first().content
    folder = tmp_path / name
    folder.mkdir()
    (folder / "a.txt").write_bytes(change(bytes(whole)))
    return sorted(int(r.id) for r in archives.read_archives(spark, str(folder)).collect())


@pytest.mark.parametrize("cut", [2, 100, 480, 700, 800])
def test_a_file_cut_off_keeps_its_whole_records(spark, tmp_path, cut):
    assert raw_archive(spark, tmp_path, "cut", lambda whole: whole[:-cut]) == [0, 1, 2, 3]


def test_bytes_before_the_first_record_and_damage_inside(spark, tmp_path):
    assert raw_archive(spark, tmp_path, "junk", lambda whole: b"some \r\n\r\n junk" + whole) == [0, 1, 2, 3, 4]
    third = lambda whole: whole.replace(b"Content-Length: 5", b"Content-Longth: 5", 5)
    assert raw_archive(spark, tmp_path, "none", third) == []

    def damaged(whole):
        at = [i for i in range(len(whole)) if whole.startswith(b"WARC/1.", i)][3]
        return whole[:at] + whole[at:].replace(b"Content-Length", b"Content-Longth", 2)

    assert raw_archive(spark, tmp_path, "inside", damaged) == [0, 1, 2]


def test_dates_are_utc_in_any_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        path = new_path(spark, "dated")
        frame = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
        archives.write_archives(archives.with_record_types(frame), path)
        line = spark.read.text(path).where(F.col("value").startswith("WARC-Date")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    stated = datetime.strptime(line.strip(), "WARC-Date: %Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)
    assert abs((datetime.now(timezone.utc) - stated).total_seconds()) < 600


def test_a_very_long_payload(spark):
    body = "long text WARC/1.1\r\n\r\n" * 30_000
    frame = spark.createDataFrame([(1, "u", body), (2, "u", body), (3, "u", "x")], "page_id long, url string, html string")
    assert read(frame) == expected([(1, body), (2, body), (3, "x")])
