from __future__ import annotations

import pytest

from hiatus.operators import identity, profile
from hiatus.sources import normalize_events
from hiatus.schema import RAW_EVENTS


@pytest.fixture(scope="module")
def raw(spark):
    good = "2024-0{}-01T10:00:00Z"
    return spark.createDataFrame(
        [
            ("u", good.format(1), "a1", "A", "t1", "x"),
            ("u", good.format(1), "a1", "A", None, "x"),
            ("u", good.format(3), None, "A", "t2", "y"),
            ("v", good.format(3), "a2", "B", "t3", "y"),
            ("v", good.format(3), "a3", "B", "t4", "y"),
            ("v", good.format(3), None, "B", None, "y"),
            ("v", good.format(3), None, None, None, "z"),
            ("v", good.format(3), None, None, "t5", "z"),
            ("w", "bad", "a9", "Z", "t9", "z"),
            ("w", good.format(3), "a9", None, "t9", None),
        ],
        RAW_EVENTS,
    )


@pytest.fixture(scope="module")
def clean(raw):
    return normalize_events(raw)


def one(frame):
    [row] = frame.collect()
    return row.asDict()


def test_raw_quality(raw):
    assert one(profile.raw_quality(raw)) == {
        "raw_rows": 10,
        "invalid_timestamp_rows": 1,
        "null_track_name_rows_raw": 1,
        "null_artist_name_rows_raw": 3,
    }


def test_missing_profile(clean):
    assert one(profile.missing_profile(clean)) == {
        "total_rows": 8,
        "null_artist_id_rows": 4,
        "null_track_id_rows": 3,
        "null_artist_name_rows": 2,
        "null_track_name_rows": 0,
        "distinct_artist_ids": 3,
        "distinct_track_ids": 5,
        "distinct_artist_names": 2,
        "distinct_track_names": 3,
    }


def test_coverage_and_profile(clean):
    coverage = one(profile.date_coverage(clean))
    assert (coverage["normalized_rows"], coverage["distinct_years"]) == (8, 1)
    assert coverage["distinct_months"] == 2
    whole = one(profile.dataset_profile(clean))
    assert (whole["total_rows"], whole["distinct_users"]) == (8, 2)


def test_period_counts(clean):
    assert [tuple(r) for r in profile.plays_per_year(clean).collect()] == [(2024, 8)]
    months = profile.plays_per_month(clean).collect()
    assert [(r.month_start.month, r.play_count) for r in months] == [(1, 2), (3, 6)]


def test_track_names(clean):
    assert one(identity.name_map_stats(clean, identity.TRACK)) == {
        "unique_name_pairs": 3,
        "ambiguous_name_pairs": 1,
    }
    [worst] = identity.ambiguous_names(clean, identity.TRACK).collect()
    assert (worst.artist_name, worst.track_name) == ("B", "y")


def test_a_null_name_recovers_nothing(clean):
    coverage = one(identity.backfill_coverage(clean, identity.TRACK))
    assert list(coverage.values()) == [3, 1, 33.3333]
    [row] = identity.recoverable_rows(clean, identity.TRACK).collect()
    assert (row.track_name, row.example_track_id) == ("x", "t1")


def test_artist_backfill_counts_rows_of_the_join(clean):
    coverage = one(identity.backfill_coverage(clean, identity.ARTIST))
    assert list(coverage.values()) == [4, 1, 25.0]
    assert identity.recoverable_rows(clean, identity.ARTIST).count() == 1


def test_rate_is_null_when_nothing_is_missing(clean):
    complete = clean.filter("track_id is not null")
    coverage = one(identity.backfill_coverage(complete, identity.TRACK))
    assert list(coverage.values()) == [0, 0, None]


def test_empty_input(clean):
    none = clean.limit(0)
    assert one(profile.dataset_profile(none))["total_rows"] == 0
    assert one(profile.date_coverage(none))["distinct_months"] == 0
    assert one(profile.missing_profile(none))["total_rows"] == 0
    assert list(one(identity.backfill_coverage(none, identity.TRACK)).values()) == [0, 0, None]


def test_missing_rows_listing(clean):
    listed = profile.rows_missing(clean, "track_id")
    assert listed.count() == 3
    assert listed.columns == [
        "user_id", "started_at", "artist_id", "artist_name", "track_id", "track_name",
    ]


def test_backfill_join_splits_a_name_with_most_rows(spark):
    """One name has nearly all rows without an id; AQE reads its partition in pieces."""
    events = spark.range(300_000, numPartitions=8).selectExpr(
        "'u' AS user_id",
        "timestamp_seconds(id) AS started_at",
        "CAST(NULL AS string) AS artist_id",
        "'A' AS artist_name",
        "IF(id < 100, concat('t', id % 50), NULL) AS track_id",
        "IF(id < 100, concat('n', id % 50), 'n1') AS track_name",
        "sha2(CAST(id AS string), 256) AS song_id",
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = identity.recoverable_rows(events, identity.TRACK)
        assert len(found.collect()) == 299_900
        assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("kind", [identity.TRACK, identity.ARTIST])
def test_events_are_hash_aggregated_before_the_first_shuffle(clean, kind):
    for frame in (
        identity.name_map_stats(clean, kind),
        identity.backfill_coverage(clean, kind),
        profile.missing_profile(clean),
        profile.dataset_profile(clean),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
