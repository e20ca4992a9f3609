"""Times the queries and prints one JSON line.

``value`` sums the headline queries, the best of two runs after a warm-up. All others
run once and are listed with them. ``plain`` has the times of the built-in forms of
three headline queries, for comparison on the same machine.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registry.fixtures import plays
from registry.queries import PLAY_GAP, QUERIES

HEADLINES = (
    "events_normalized",
    "sessionized_events",
    "session_summary_rows",
    "session_summary_window",
    "session_boundary_inclusive",
    "session_stats",
    "top_sessions",
    "top_songs_interval_join",
    "top_songs_session_join",
    "top_songs_many_sessions",
    "top_users",
    "most_active_user",
    "first_events_of_user",
    "dataset_profile",
    "raw_quality",
    "date_coverage",
    "plays_per_month",
    "missing_profile",
    "track_map_stats",
    "ambiguous_tracks",
    "track_backfill",
    "artist_backfill",
    "recoverable_track_rows",
    "monthly_history",
    "series_features",
    "model_coefficients",
    "validation_mae",
    "forecast_all",
    "forecast_top",
    "parquet_stage_roundtrip",
)
RUNS = 2


def plain_rows(spark, sf_dir) -> DataFrame:
    """Session rows by windows over all events of a user."""
    in_time = Window.partitionBy("user_id").orderBy("started_at", "event_id")
    pause = F.unix_micros("started_at") - F.unix_micros(F.lag("started_at").over(in_time))
    opens = F.coalesce((pause > PLAY_GAP * 60_000_000).cast("int"), F.lit(1))
    rows = plays(spark, sf_dir).withColumn("is_new_session", opens)
    return rows.withColumn("session_number", F.sum("is_new_session").over(in_time))


def plain_rows_summary(spark, sf_dir) -> DataFrame:
    return (
        plain_rows(spark, sf_dir)
        .groupBy("user_id", "session_number")
        .agg(F.count("*"), F.min("started_at"), F.max("started_at"))
    )


def plain_window_summary(spark, sf_dir) -> DataFrame:
    span = F.session_window("started_at", f"{PLAY_GAP} minutes")
    sessions = plays(spark, sf_dir).groupBy("user_id", span).agg(F.count("*"), F.max("started_at"))
    in_time = Window.partitionBy("user_id").orderBy("session_window")
    return sessions.withColumn("session_number", F.row_number().over(in_time))


PLAIN = {
    "sessionized_events": plain_rows,
    "session_summary_rows": plain_rows_summary,
    "session_summary_window": plain_window_summary,
}


def seconds(spark, query, sf_dir) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def best(spark, query, sf_dir) -> float:
    seconds(spark, query, sf_dir)
    return round(min(seconds(spark, query, sf_dir) for _ in range(RUNS)), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hiatus-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    chosen = sys.argv[1:] or HEADLINES
    for name in chosen:
        timings[name] = best(spark, QUERIES[name], sf_dir)
    total = round(sum(timings.values()), 4)
    plain = {name: best(spark, query, sf_dir) for name, query in PLAIN.items() if name in timings}
    for name in () if sys.argv[1:] else sorted(set(QUERIES) - set(timings)):
        timings[name] = round(seconds(spark, QUERIES[name], sf_dir), 4)
    spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "plain": plain,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
