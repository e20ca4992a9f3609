"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiatus.operators import identity, profile, ranking, regression, series
from hiatus.operators.sessions import sessionize, summarize_events, summarize_sessionized
from hiatus.plans import forecast as forecasts
from hiatus.plans.sessions import prepare, top_songs_in_top_sessions
from hiatus.sources import (
    load_events,
    normalize_events,
    read_export,
    read_staged,
    read_tsv,
    stage_events,
    write_tsv,
)
from hiatus.streaming import read_event_files, write_closed_sessions
from registry import fixtures
from registry.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

PLAY_GAP = 360
ORDER_GAP = 1440
DECIMALS = 6
# More sessions than are broadcast, so the join on time slices runs.
MANY_SESSIONS = 2_000
GIVEN_USER = 3

QUERIES: dict[str, Query] = {}


def present(result: DataFrame) -> DataFrame:
    """Zone-less times, and doubles to six decimals without negative zero."""

    def shown(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.DateType)):
            return value.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            rounded = F.round(value, DECIMALS)
            return F.when(rounded == 0, 0.0).otherwise(rounded).alias(field.name)
        return value

    return result.select(*map(shown, result.schema.fields))


def query(build: Query) -> Query:
    """Registers a query under its function name; times are read and shown in UTC."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return present(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return run


def _normalized(spark, sf_dir):
    return normalize_events(fixtures.raw_plays(spark, sf_dir))


def _play_rows(spark, sf_dir):
    return sessionize(fixtures.plays(spark, sf_dir), PLAY_GAP, ["event_id"])


def _play_sessions(spark, sf_dir):
    return summarize_events(fixtures.plays(spark, sf_dir), PLAY_GAP)


def _order_sessions(spark, sf_dir):
    return summarize_events(fixtures.nation_orders(spark, sf_dir), ORDER_GAP)


def _history(spark, sf_dir, metric="session_count"):
    return series.monthly_history(_order_sessions(spark, sf_dir), metric)


def _features(spark, sf_dir):
    return series.series_features(_history(spark, sf_dir))


def _forecast(spark, sf_dir, **options):
    return forecasts.forecast_users(_order_sessions(spark, sf_dir), **options)


# Events


@query
def events_normalized(spark, sf_dir):
    return _normalized(spark, sf_dir)


@query
def parsed_times(spark, sf_dir):
    return profile.parsed_times(fixtures.raw_plays(spark, sf_dir))


@query
def parquet_stage_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "staged")
    stage_events(fixtures.plays(spark, sf_dir), path)
    return read_staged(spark, path)


@query
def tsv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    write_tsv(fixtures.raw_plays(spark, sf_dir), path, header=False, null_value="")
    return read_tsv(spark, path)


@query
def tsv_export_sessions(spark, sf_dir):
    sessions = _play_sessions(spark, sf_dir)
    path = write_tsv(sessions, scratch_path(spark, "sessions"))
    return read_export(spark, path, sessions.schema)


@query
def tsv_export_texts(spark, sf_dir):
    """Names with spaces at both ends, quotes and tabs, empty, missing and marker-like ones, and times in microseconds."""
    odd = F.col("event_id") % 7
    padded = (
        F.when(odd == 1, "")
        .when(odd == 2, F.lit(None))
        .when(odd == 3, "\\N")
        .otherwise(F.concat(F.lit('  "a"\t'), "artist_name", F.lit(" ")))
    )
    texts = fixtures.plays(spark, sf_dir).select("event_id", padded.alias("artist_name"), "started_at")
    path = write_tsv(texts, scratch_path(spark, "texts"), header=False)
    return read_export(spark, path, texts.schema, header=False)


@query
def parquet_folder_load(spark, sf_dir):
    path = scratch_path(spark, "events")
    stage_events(fixtures.plays(spark, sf_dir), path)
    return load_events(spark, path)


@query
def prepared_sessions(spark, sf_dir):
    """Export, load, stage and materialise, as one call."""
    path = write_tsv(fixtures.raw_plays(spark, sf_dir), scratch_path(spark, "raw"), header=False, null_value="")
    return prepare(spark, path, scratch_path(spark, "staged"), PLAY_GAP).sessions


# Sessions


@query
def session_summary_unnumbered(spark, sf_dir):
    return summarize_sessionized(_play_rows(spark, sf_dir).drop("session_number"))


@query
def sessionized_events(spark, sf_dir):
    return _play_rows(spark, sf_dir)


@query
def sessionized_events_hot(spark, sf_dir):
    """Every block is cut into cells."""
    return sessionize(fixtures.plays(spark, sf_dir), PLAY_GAP, ["event_id"], block_rows=0)


@query
def session_summary_rows(spark, sf_dir):
    return summarize_sessionized(_play_rows(spark, sf_dir))


@query
def session_summary_window(spark, sf_dir):
    return _play_sessions(spark, sf_dir)


@query
def session_boundary_inclusive(spark, sf_dir):
    return _order_sessions(spark, sf_dir)


@query
def session_summary_zero_gap(spark, sf_dir):
    """Orders of one instant make a session, all others are alone."""
    return summarize_events(fixtures.nation_orders(spark, sf_dir), 0)


@query
def session_summary_second_gap(spark, sf_dir):
    return summarize_events(fixtures.plays(spark, sf_dir), 1 / 60)


@query
def session_stream(spark, sf_dir):
    """The sessions that a stream of the event files has closed, as written by its sink."""
    path = f"{sf_dir}/events.parquet"
    files = read_event_files(spark, f"{path}*", spark.read.parquet(path).schema)  # a file or a folder
    out = scratch_path(spark, "closed")
    events = files.select("user_id", F.col("ts").alias("started_at"))
    write_closed_sessions(events, out, scratch_path(spark, "state"), PLAY_GAP)
    return spark.read.parquet(out)


@query
def prepared_rows(spark, sf_dir):
    """Staged anew, with numbered rows, of which the users' sessions are counted."""
    path = write_tsv(fixtures.raw_plays(spark, sf_dir), scratch_path(spark, "raw"), header=False, null_value="")
    rows = prepare(spark, path, scratch_path(spark, "staged"), PLAY_GAP, refresh=True, with_rows=True).sessionized
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("plays"), F.max("session_number").alias("sessions"))


@query
def session_stats(spark, sf_dir):
    return profile.session_stats(_play_sessions(spark, sf_dir))


# Rankings


@query
def top_sessions(spark, sf_dir):
    return ranking.top_sessions(_play_sessions(spark, sf_dir))


@query
def longest_sessions_preview(spark, sf_dir):
    return ranking.top_sessions(_play_sessions(spark, sf_dir), 20)


@query
def top_sessions_ranked(spark, sf_dir):
    return ranking.ranked_sessions(_play_sessions(spark, sf_dir))


@query
def top_songs_interval_join(spark, sf_dir):
    events = fixtures.plays(spark, sf_dir)
    return top_songs_in_top_sessions(events, summarize_events(events, PLAY_GAP))


@query
def top_songs_session_join(spark, sf_dir):
    return top_songs_in_top_sessions(_play_rows(spark, sf_dir), _play_sessions(spark, sf_dir))


@query
def top_songs_session_join_many(spark, sf_dir):
    return top_songs_in_top_sessions(
        _play_rows(spark, sf_dir), _play_sessions(spark, sf_dir), session_count=MANY_SESSIONS
    )


@query
def top_songs_pruned_join(spark, sf_dir):
    """Only blocks of the chosen sessions are numbered."""
    events = fixtures.plays(spark, sf_dir)
    return top_songs_in_top_sessions(events, _play_sessions(spark, sf_dir), gap_minutes=PLAY_GAP)


@query
def top_songs_pruned_join_many(spark, sf_dir):
    return top_songs_in_top_sessions(
        fixtures.plays(spark, sf_dir), _play_sessions(spark, sf_dir), MANY_SESSIONS, gap_minutes=PLAY_GAP
    )


@query
def top_songs_from_rows(spark, sf_dir):
    return top_songs_in_top_sessions(_play_rows(spark, sf_dir))


@query
def top_sessions_from_rows(spark, sf_dir):
    return ranking.top_sessions(_play_rows(spark, sf_dir))


@query
def top_users_from_rows(spark, sf_dir):
    return ranking.top_users(_play_rows(spark, sf_dir))


@query
def top_songs_many_sessions(spark, sf_dir):
    events = fixtures.plays(spark, sf_dir)
    sessions = summarize_events(events, PLAY_GAP)
    return top_songs_in_top_sessions(events, sessions, session_count=MANY_SESSIONS)


@query
def top_songs_ranked(spark, sf_dir):
    events = fixtures.plays(spark, sf_dir)
    songs = top_songs_in_top_sessions(events, summarize_events(events, PLAY_GAP))
    return ranking.ranked_songs(songs)


@query
def top_users(spark, sf_dir):
    return ranking.top_users(_play_sessions(spark, sf_dir))


@query
def top_user(spark, sf_dir):
    return ranking.top_user(_play_sessions(spark, sf_dir))


@query
def plays_per_user(spark, sf_dir):
    return ranking.plays_per_user(fixtures.plays(spark, sf_dir))


@query
def most_active_user(spark, sf_dir):
    return ranking.most_active_user(fixtures.plays(spark, sf_dir))


@query
def first_events_of_user(spark, sf_dir):
    events = fixtures.plays(spark, sf_dir)
    return ranking.first_events(
        events, ranking.most_active_user(events), tie_break=["event_id"]
    )


@query
def first_events_of_given_user(spark, sf_dir):
    return ranking.first_events(fixtures.plays(spark, sf_dir), GIVEN_USER, tie_break=["event_id"])


@query
def first_events_sessionized(spark, sf_dir):
    events = fixtures.plays(spark, sf_dir)
    sample = ranking.first_events(
        events, ranking.most_active_user(events), tie_break=["event_id"]
    )
    return sessionize(sample, PLAY_GAP, ["event_id"])


# Profile


@query
def dataset_profile(spark, sf_dir):
    return profile.dataset_profile(_normalized(spark, sf_dir))


@query
def raw_quality(spark, sf_dir):
    return profile.raw_quality(fixtures.raw_plays(spark, sf_dir))


@query
def date_coverage(spark, sf_dir):
    return profile.date_coverage(_normalized(spark, sf_dir))


@query
def order_date_coverage(spark, sf_dir):
    return profile.date_coverage(fixtures.nation_orders(spark, sf_dir))


@query
def plays_per_year(spark, sf_dir):
    return profile.plays_per_year(fixtures.nation_orders(spark, sf_dir))


@query
def plays_per_month(spark, sf_dir):
    return profile.plays_per_month(fixtures.nation_orders(spark, sf_dir))


@query
def missing_profile(spark, sf_dir):
    return profile.missing_profile(_normalized(spark, sf_dir))


@query
def missing_track_rows(spark, sf_dir):
    return profile.rows_missing(_normalized(spark, sf_dir), "track_id")


@query
def missing_artist_rows(spark, sf_dir):
    return profile.rows_missing(_normalized(spark, sf_dir), "artist_id")


# Names and ids


@query
def track_map(spark, sf_dir):
    return identity.name_map(_normalized(spark, sf_dir), identity.TRACK)


@query
def track_map_stats(spark, sf_dir):
    return identity.name_map_stats(_normalized(spark, sf_dir), identity.TRACK)


@query
def ambiguous_tracks(spark, sf_dir):
    return identity.ambiguous_names(_normalized(spark, sf_dir), identity.TRACK)


@query
def recoverable_track_rows(spark, sf_dir):
    return identity.recoverable_rows(_normalized(spark, sf_dir), identity.TRACK)


@query
def track_backfill(spark, sf_dir):
    return identity.backfill_coverage(_normalized(spark, sf_dir), identity.TRACK)


@query
def artist_map(spark, sf_dir):
    return identity.name_map(_normalized(spark, sf_dir), identity.ARTIST)


@query
def artist_map_stats(spark, sf_dir):
    return identity.name_map_stats(_normalized(spark, sf_dir), identity.ARTIST)


@query
def ambiguous_artists(spark, sf_dir):
    return identity.ambiguous_names(_normalized(spark, sf_dir), identity.ARTIST)


@query
def recoverable_artist_rows(spark, sf_dir):
    return identity.recoverable_rows(_normalized(spark, sf_dir), identity.ARTIST)


@query
def artist_backfill(spark, sf_dir):
    return identity.backfill_coverage(_normalized(spark, sf_dir), identity.ARTIST)


# Series


@query
def monthly_metrics(spark, sf_dir):
    return series.monthly_metrics(_order_sessions(spark, sf_dir))


@query
def monthly_history(spark, sf_dir):
    return series.with_series_totals(_history(spark, sf_dir))


@query
def monthly_history_duration(spark, sf_dir):
    return _history(spark, sf_dir, "avg_session_duration_minutes")


@query
def monthly_history_top_user(spark, sf_dir):
    history = series.top_user_history(_order_sessions(spark, sf_dir))
    return series.with_series_totals(history, "top_user_session_count")


@query
def series_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query
def usable_rows(spark, sf_dir):
    return series.usable_rows(_features(spark, sf_dir))


@query
def holdout_split(spark, sf_dir):
    return series.holdout_split(series.usable_rows(_features(spark, sf_dir)))


@query
def history_head(spark, sf_dir):
    return series.series_head(_history(spark, sf_dir), 12)


@query
def history_tail(spark, sf_dir):
    return series.series_tail(_history(spark, sf_dir), 12)


# Models


@query
def model_coefficients(spark, sf_dir):
    return _forecast(spark, sf_dir).coefficients


@query
def validation_table(spark, sf_dir):
    return _forecast(spark, sf_dir).validation


@query
def validation_mae(spark, sf_dir):
    return _forecast(spark, sf_dir).errors


@query
def forecast_all(spark, sf_dir):
    return _forecast(spark, sf_dir).forecast


@query
def forecast_all_duration(spark, sf_dir):
    return _forecast(spark, sf_dir, metric="avg_session_duration_minutes").forecast


@query
def forecast_without_refit(spark, sf_dir):
    return _forecast(spark, sf_dir, refit=False).forecast


@query
def forecast_given_users(spark, sf_dir):
    users = fixtures.nation_orders(spark, sf_dir).where(F.col("user_id") < 5).select("user_id").distinct()
    return _forecast(spark, sf_dir, users=users).forecast


@query
def forecast_top(spark, sf_dir):
    return forecasts.forecast_top_user(_order_sessions(spark, sf_dir)).forecast


@query
def history_and_forecast(spark, sf_dir):
    return forecasts.history_and_forecast(_forecast(spark, sf_dir))
