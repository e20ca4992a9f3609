"""Streamed sessions against the batch sessions that the watermark has closed."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from hiatus.operators.sessions import summarize_events
from hiatus.streaming import read_event_files, write_closed_sessions

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "user_id long, started_at timestamp"


def rows(seed, first, hours, size=300):
    draw = random.Random(seed)
    return [(draw.choice([1, 2, 3, None]), START + timedelta(hours=first, seconds=draw.randrange(hours * 3600))) for _ in range(size)]


def keys(frame):
    shown = frame.select("user_id", "track_count", F.unix_micros("session_start"), F.unix_micros("session_end"), "session_duration_seconds")
    return sorted(map(tuple, shown.collect()), key=repr)


def test_restart_goes_on_from_its_checkpoint(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    parts = [rows(1, 0, 30), rows(2, 29, 30), rows(3, 58, 30)]
    seen = []
    for part in parts:
        seen += part
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        events = read_event_files(spark, source, spark.read.parquet(source).schema)
        write_closed_sessions(events, out, state, 20, "2 hours")
        all_rows = spark.createDataFrame(seen, SCHEMA)
        mark = max(t for _, t in seen) - timedelta(hours=2, minutes=20)
        closed = summarize_events(all_rows, 20).where(F.col("session_end") <= F.lit(mark))
        found = keys(spark.read.parquet(out))
        assert found == keys(closed)
        assert len(found) == len(set(found))
    assert 0 < len(found) < summarize_events(spark.createDataFrame(seen, SCHEMA), 20).count()


def test_no_rows_and_rows_without_time(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([(1, None)], SCHEMA).write.parquet(source)
    events = read_event_files(spark, source, spark.read.parquet(source).schema)
    write_closed_sessions(events, out, state)
    assert spark.read.schema("user_id long").parquet(out).count() == 0
