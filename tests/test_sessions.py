from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hiatus.operators.sessions import sessionize, summarize_events, summarize_sessionized
from hiatus.schema import SESSION_COLUMNS

DAY = "2024-03-01 "


def counts(events, **options):
    rows = summarize_events(events, **options).orderBy("user_id", "session_number").collect()
    return [(r.user_id, r.track_count) for r in rows]


def both_ways(events, **options):
    direct = summarize_events(events, **options)
    through_rows = summarize_sessionized(sessionize(events, tie_break=["event_id"], **options))
    assert direct.columns == through_rows.columns == list(SESSION_COLUMNS)
    assert direct.dtypes == through_rows.dtypes
    assert sorted(map(str, direct.collect())) == sorted(map(str, through_rows.collect()))
    return counts(events, **options)


def test_gap_equal_to_threshold_stays_in_the_session(events):
    assert both_ways(events(("u", DAY + "00:00:00"), ("u", DAY + "00:20:00"))) == [("u", 2)]


def test_gap_one_second_over_splits(events):
    frame = events(("u", DAY + "00:00:00"), ("u", DAY + "00:20:01"))
    assert both_ways(frame) == [("u", 1), ("u", 1)]


def test_gap_half_a_second_over_splits_in_both_paths(events):
    frame = events(("u", DAY + "00:00:00"), ("u", DAY + "00:20:00.5"))
    assert both_ways(frame) == [("u", 1), ("u", 1)]
    rows = sessionize(frame).orderBy("started_at").collect()
    assert [r.gap_seconds for r in rows] == [None, 1200]
    assert [r.is_new_session for r in rows] == [1, 1]


def test_gap_one_microsecond_around_the_threshold(events):
    over = events(("u", DAY + "00:00:00.000001"), ("u", DAY + "00:20:00.000002"))
    exact = events(("u", DAY + "00:00:00.000001"), ("u", DAY + "00:20:00.000001"))
    assert len(both_ways(over)) == 2
    assert len(both_ways(exact)) == 1


def test_ties_share_a_session_with_gap_zero(events):
    frame = events(("u", DAY + "10:00:00"), ("u", DAY + "10:00:00"), ("u", DAY + "10:00:00"))
    assert both_ways(frame) == [("u", 3)]
    rows = sessionize(frame, tie_break=["event_id"]).orderBy("event_id").collect()
    assert [r.gap_seconds for r in rows] == [None, 0, 0]
    assert [r.is_new_session for r in rows] == [1, 0, 0]


def test_single_event(events):
    [row] = summarize_events(events(("u", DAY + "10:00:00"))).collect()
    assert (row.track_count, row.session_duration_seconds, row.session_number) == (1, 0, 1)
    assert row.session_id == "u-00000001"


def test_users_are_numbered_independently(events):
    frame = events(
        ("a", DAY + "10:00:00"),
        ("b", DAY + "10:01:00"),
        ("a", DAY + "11:00:00"),
        ("b", DAY + "10:05:00"),
    )
    assert both_ways(frame) == [("a", 1), ("a", 1), ("b", 2)]


def test_null_user_and_null_time(events):
    frame = events((None, DAY + "10:00:00"), (None, DAY + "10:10:00"), ("a", None))
    assert both_ways(frame) == [(None, 2)]


def test_times_before_1970(events):
    frame = events(
        ("u", "1969-12-31 23:50:00"), ("u", "1970-01-01 00:10:00"), ("u", "1969-12-31 23:29:59")
    )
    assert both_ways(frame) == [("u", 1), ("u", 2)]


def test_empty_input(events, spark):
    none = events(("u", DAY + "10:00:00")).limit(0)
    assert summarize_events(none).count() == 0
    assert sessionize(none).count() == 0


def test_zero_gap_and_negative_gap(events):
    frame = events(("u", DAY + "10:00:00"), ("u", DAY + "10:00:00"), ("u", DAY + "10:00:00.000001"))
    assert both_ways(frame, gap_minutes=0) == [("u", 2), ("u", 1)]
    with pytest.raises(ValueError):
        summarize_events(frame, gap_minutes=-1)


def test_long_session_numbers_are_not_cut(spark):
    from hiatus.functions import session_id

    frame = spark.createDataFrame([("u", 7), ("u", 123456789)], "user_id string, n long")
    ids = [r[0] for r in frame.select(session_id(F.col("user_id"), F.col("n"))).collect()]
    assert ids == ["u-00000007", "u-123456789"]


def random_events(spark, seed, size=400):
    """Bursts, ties, exact copies and long pauses, mostly of one user."""
    draw = random.Random(seed)
    start = datetime(2023, 12, 30, tzinfo=timezone.utc)
    rows = []
    clock = {}
    for index in range(size):
        user = "busy" if draw.random() < 0.7 else draw.choice(["a", "b", None])
        step = draw.choice([0, 0, 0.25, 1, 30, 1199.5, 1200, 1200.5, 1201, 90_000])
        clock[user] = clock.get(user, start) + timedelta(seconds=step)
        rows.append((index, user, clock[user]))
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, "event_id long, user_id string, started_at timestamp")
    return rows, frame.repartition(5)


def brute_force(rows, gap_seconds):
    found = {}
    last, number = {}, {}
    for index, user, moment in sorted(rows, key=lambda r: (str(r[1]), r[2], r[0])):
        previous = last.get(user)
        opens = previous is None or (moment - previous).total_seconds() > gap_seconds
        number[user] = number.get(user, 0) + opens
        found[index] = (
            None if previous is None else previous.replace(tzinfo=None),
            int(opens),
            number[user],
        )
        last[user] = moment
    return found


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block_rows", [5_000_000, 100, 0])
def test_rows_match_brute_force_whatever_the_blocks_hold(spark, seed, block_rows):
    rows, frame = random_events(spark, seed)
    result = sessionize(frame, 20, ["event_id"], block_rows=block_rows)
    plain = result.withColumn("previous", F.col("previous_started_at").cast("timestamp_ntz"))
    found = {
        r.event_id: (r.previous, r.is_new_session, r.session_number) for r in plain.collect()
    }
    assert found == brute_force(rows, 1200)


def test_hot_copies_without_a_key_keep_every_row(spark):
    """A third of all rows are copies of one event, with nothing to tell them apart."""
    moment = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
    rows = [("u", moment)] * 300 + [("u", moment + timedelta(seconds=s)) for s in range(1, 601)]
    frame = spark.createDataFrame(rows, "user_id string, started_at timestamp").repartition(6)
    result = sessionize(frame, block_rows=10).cache()
    assert result.count() == 900
    assert result.filter("is_new_session = 1").count() == 1
    assert result.filter("session_number = 1").count() == 900
    assert result.filter("gap_seconds = 0").count() == 299
    result.unpersist()


def test_matches_the_builtin_session_window(spark):
    _, frame = random_events(spark, 3)
    builtin = frame.groupBy("user_id", F.session_window("started_at", "20 minutes")).agg(
        F.count("*").alias("track_count"),
        F.min("started_at").alias("session_start"),
        F.max("started_at").alias("session_end"),
    )
    ours = summarize_events(frame)
    columns = ["user_id", "track_count", "session_start", "session_end"]
    assert sorted(map(str, builtin.select(columns).collect())) == sorted(
        map(str, ours.select(columns).collect())
    )


@pytest.mark.parametrize("gap_seconds", [0, 0.001, 0.25, 1, 60])
def test_small_gaps_match_brute_force(spark, gap_seconds):
    """Bursts of microseconds up to pauses of hours, across the blocks of every level."""
    draw = random.Random(11)
    clock, rows = {}, []
    for index in range(600):
        user = "busy" if draw.random() < 0.7 else draw.choice(["a", None])
        step = draw.choice([0, 1, 2, 511, 512, 1_000, 250_000, 250_001, 1_000_000, 60_000_000, 9_000_000_000])
        start = datetime(1969, 12, 31, 20, tzinfo=timezone.utc)
        clock[user] = clock.get(user, start) + timedelta(microseconds=step)
        rows.append((index, user, clock[user]))
    frame = spark.createDataFrame(rows, "event_id long, user_id string, started_at timestamp").repartition(5)
    expected = {}
    for index, (_, _, number) in brute_force(rows, gap_seconds).items():
        user, moment = rows[index][1], rows[index][2].replace(tzinfo=None)
        expected.setdefault((user, number), []).append(moment)
    sessions = summarize_events(frame, gap_seconds / 60).select(
        "user_id",
        "session_number",
        "track_count",
        F.col("session_start").cast("timestamp_ntz"),
        F.col("session_end").cast("timestamp_ntz"),
    )
    assert {(r[0], r[1]): tuple(r[2:]) for r in sessions.collect()} == {
        key: (len(times), min(times), max(times)) for key, times in expected.items()
    }
    numbered = sessionize(frame, gap_seconds / 60, ["event_id"]).select("event_id", "session_number").collect()
    assert dict(map(tuple, numbered)) == {i: x[2] for i, x in brute_force(rows, gap_seconds).items()}


def test_small_gaps_sort_a_user_in_blocks(spark):
    """Of a user with two thirds of all rows, only blocks of 512 seconds meet in one window."""
    user = F.when(F.col("id") % 3 == 0, "v").otherwise("u")
    seconds = F.timestamp_seconds(F.col("id") * 2)
    frame = spark.range(30_000).select(user.alias("user_id"), seconds.alias("started_at"))
    result = summarize_events(frame, 1 / 60)
    assert result.count() == 30_000
    plan = result._jdf.queryExecution().optimizedPlan().toString().splitlines()
    windows = [at for at, line in enumerate(plan) if "Window [" in line]
    per_user = [at for at in windows if "block#" not in plan[at].rsplit("], [", 2)[1]]
    assert 0 < len(per_user) < len(windows)
    beneath = next(line for line in plan[per_user[-1] :] if "Aggregate [" in line)
    assert "block#" in beneath


@pytest.mark.parametrize("gap_minutes", [0, 1 / 60])
def test_small_gaps_read_the_events_once(spark, tmp_path, gap_minutes):
    """Every level of blocks starts from the shuffle of the one below."""
    seconds = F.timestamp_micros(F.col("id") * 700_000)
    spark.range(5_000).select((F.col("id") % 3).alias("user_id"), seconds.alias("started_at")).write.parquet(
        str(tmp_path / "events")
    )
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows reuse only after it has run
    try:
        result = summarize_events(spark.read.parquet(str(tmp_path / "events")), gap_minutes)
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert plan.count("FileScan") == 1
    assert plan.count("ReusedExchange") >= 1
    assert result.agg(F.sum("track_count")).first()[0] == 5_000


def test_sessions_of_a_user_are_more_than_a_gap_apart(spark):
    from pyspark.sql import Window

    _, frame = random_events(spark, 4)
    in_order = Window.partitionBy("user_id").orderBy("session_number")
    pause = F.unix_micros("session_start") - F.unix_micros(F.lag("session_end").over(in_order))
    sessions = summarize_events(frame).withColumn("pause", pause)
    assert sessions.filter(F.col("pause") <= 1200 * 1_000_000).count() == 0
    assert sessions.agg(F.sum("track_count")).first()[0] == frame.count()


def test_summary_reads_two_columns_and_aggregates_before_the_shuffle(spark):
    from conftest import TEST_TABLES
    from registry.fixtures import plays

    plan = summarize_events(plays(spark, TEST_TABLES), 360)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in physical
    assert physical.count("Exchange hashpartitioning") == 2
    assert "partial_min" in physical


def test_rows_are_sorted_only_by_windows(spark):
    """No aggregate falls back to sorting events, and ordinary rows cross one shuffle."""
    _, frame = random_events(spark, 5)
    result = sessionize(frame, 20, ["event_id"])
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortAggregate" not in plan
    assert "SortMergeJoin" not in plan


def test_crowded_instants_are_dealt_over_parts(spark):
    """A third of all rows at one instant, and no task orders more than a share of them."""
    moment = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
    rows = [(n, "u", moment) for n in range(3000)]
    rows += [(5000 + s, "u", moment + timedelta(seconds=s - 3000)) for s in range(6000) if s != 3000]
    frame = spark.createDataFrame(rows, "event_id long, user_id string, started_at timestamp").repartition(6)
    result = sessionize(frame, 20, ["event_id"], block_rows=1000)
    found = {
        r.event_id: (r.p, r.is_new_session, r.session_number)
        for r in result.withColumn("p", F.col("previous_started_at").cast("timestamp_ntz")).collect()
    }
    assert found == brute_force(rows, 1200)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "_part#" in plan and plan.count("Window [sum(") <= 3


def test_lists_of_many_crowded_blocks_are_not_broadcast(spark):
    """Small blocks may be as many as rows; what is told to them is joined by shuffle."""
    rows, frame = random_events(spark, 7)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = sessionize(frame, 20, ["event_id"], block_rows=0)
        plain = result.withColumn("previous", F.col("previous_started_at").cast("timestamp_ntz"))
        found = {r.event_id: (r.previous, r.is_new_session, r.session_number) for r in plain.collect()}
        plan = plain._jdf.queryExecution().executedPlan().toString()
        few = sessionize(frame, 20, ["event_id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found == brute_force(rows, 1200)
    assert "Broadcast" not in plan and "BroadcastHashJoin" in few


def test_rows_are_read_once_when_no_block_is_crowded(spark, tmp_path):
    """The cells' branch is dropped: rows are read for the slices and to be numbered."""
    _, frame = random_events(spark, 6)
    frame.write.parquet(str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))

    def scans(**options):
        result = sessionize(frame, 20, ["event_id"], **options)
        result.collect()
        final = result._jdf.queryExecution().executedPlan().toString()
        assert "Final Plan" in final
        return final.split("Initial Plan")[0].count("Scan parquet")

    assert scans() == 2
    assert scans(block_rows=10) > 2


@pytest.mark.parametrize("few, block_rows", [(True, 5_000_000), (False, 5_000_000), (True, 3)])
def test_rows_within_chosen_sessions_keep_their_numbers(spark, few, block_rows):
    """Only blocks that a chosen session touches are numbered, as they are among all rows."""
    draw = random.Random(5)
    rows = []
    for user in ("u", "v", None):
        moment = datetime(1969, 12, 31, 23, tzinfo=timezone.utc)
        for _ in range(150):
            moment += timedelta(seconds=draw.choice([0, 0.4, 1, 1, 1.5, 90, 4_000]))
            rows.append((len(rows), user, moment))
    frame = spark.createDataFrame(rows, "event_id long, user_id string, started_at timestamp").repartition(4)
    gap = 1 / 60
    sessions = summarize_events(frame, gap)
    chosen = sessions.where("track_count > 1 and session_number % 3 = 0 or session_number = 1")
    names = ["event_id", "session_number", "is_new_session", "previous_started_at"]
    everything = {r[0]: tuple(r) for r in sessionize(frame, gap, ["event_id"]).select(names).collect()}
    pruned = sessionize(frame, gap, ["event_id"], within=chosen, few=few, block_rows=block_rows)
    found = {r[0]: tuple(r) for r in pruned.select(names).collect()}
    block = 512
    touched = {
        (r.user_id, at)
        for r in chosen.select("user_id", F.col("session_start").cast("long").alias("a"), F.col("session_end").cast("long").alias("b")).collect()
        for at in range(r.a // block, r.b // block + 1)
    }
    expected = {i for i, user, moment in rows if (user, int(moment.timestamp() // 1) // block) in touched}
    assert set(found) == expected and len(expected) < len(rows)
    assert all(found[i] == everything[i] for i in expected)
    assert pruned.columns == sessionize(frame, gap).columns
