"""Dataset profile: volumes, date coverage, missing values.

Distinct counts next to plain counts would make Spark copy every row once per
distinct column. Where that matters the operators aggregate by the value first
(combined on the map side) and count the groups afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiatus.functions import utc_clock, utc_instant
from hiatus.sources import parse_start

_ROW_LISTING = ("user_id", "started_at", "artist_id", "artist_name", "track_id", "track_name")


def dataset_profile(events: DataFrame) -> DataFrame:
    """One row: events, distinct users, first and last event."""
    per_user = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("plays"),
        F.min("started_at").alias("first_play"),
        F.max("started_at").alias("last_play"),
    )
    return per_user.agg(
        F.coalesce(F.sum("plays"), F.lit(0).cast("long")).alias("total_rows"),
        F.count("user_id").alias("distinct_users"),
        F.min("first_play").alias("min_started_at"),
        F.max("last_play").alias("max_started_at"),
    )


def parsed_times(raw: DataFrame) -> DataFrame:
    """Raw time text beside the parsed time."""
    return raw.select("started_at_raw", parse_start(F.col("started_at_raw")).alias("started_at"))


def raw_quality(raw: DataFrame) -> DataFrame:
    """One row: raw rows, unparsable times, missing track and artist names."""
    return raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(parse_start(F.col("started_at_raw")).isNull()).alias("invalid_timestamp_rows"),
        F.count_if(F.col("track_name").isNull()).alias("null_track_name_rows_raw"),
        F.count_if(F.col("artist_name").isNull()).alias("null_artist_name_rows_raw"),
    )


def date_coverage(events: DataFrame) -> DataFrame:
    """One row: events, time bounds, distinct years and months."""
    per_month = events.groupBy(F.trunc(utc_clock(F.col("started_at")).cast("date"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("plays"),
        F.min("started_at").alias("first_play"),
        F.max("started_at").alias("last_play"),
    )
    return per_month.agg(
        F.coalesce(F.sum("plays"), F.lit(0).cast("long")).alias("normalized_rows"),
        F.min("first_play").alias("min_started_at"),
        F.max("last_play").alias("max_started_at"),
        F.count_distinct(F.year("month")).alias("distinct_years"),
        F.count("month").alias("distinct_months"),
    )


def plays_per_year(events: DataFrame) -> DataFrame:
    counts = events.groupBy(F.year(utc_clock(F.col("started_at"))).alias("year"))
    return counts.agg(F.count(F.lit(1)).alias("play_count")).orderBy("year")


def plays_per_month(events: DataFrame) -> DataFrame:
    counts = events.groupBy(_month_start().alias("month_start"))
    return counts.agg(F.count(F.lit(1)).alias("play_count")).orderBy("month_start")


def _month_start():
    """First instant of the UTC month, as a time."""
    month = F.date_trunc("month", utc_clock(F.col("started_at")))
    return utc_instant(month)


def missing_profile(events: DataFrame) -> DataFrame:
    """One row: events, missing and distinct values of the id and name columns.

    The events are read once: every row gives a (column, value) pair for each
    column, and pairs are counted before they are shuffled.
    """
    columns = ("artist_id", "track_id", "artist_name", "track_name")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    by_value = (
        events.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    )
    stacked = by_value.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("rows")).otherwise(0)).alias("missing"),
        F.count("value").alias("distinct"),
    )

    def of(column: str, measure: str):
        return F.coalesce(F.max(F.when(F.col("column") == column, F.col(measure))), F.lit(0))

    return stacked.agg(
        F.coalesce(F.max("rows"), F.lit(0)).alias("total_rows"),
        *[of(c, "missing").alias(f"null_{c}_rows") for c in columns],
        *[of(c, "distinct").alias(f"distinct_{c}s") for c in columns],
    )


def rows_missing(events: DataFrame, column: str) -> DataFrame:
    """Events whose id is missing."""
    return events.filter(F.col(column).isNull()).select(*_ROW_LISTING)


def session_stats(sessions: DataFrame) -> DataFrame:
    """One row: sessions, average and largest number of tracks per session."""
    return sessions.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.avg("track_count").alias("avg_tracks_per_session"),
        F.max("track_count").alias("max_tracks_in_one_session"),
    )
