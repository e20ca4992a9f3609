"""Column layouts shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiatus.functions.times import utc_instant

# The delimited event file has these six string fields and no header.
RAW_EVENTS = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("started_at_raw", T.StringType(), False),
        T.StructField("artist_id", T.StringType(), True),
        T.StructField("artist_name", T.StringType(), True),
        T.StructField("track_id", T.StringType(), True),
        T.StructField("track_name", T.StringType(), True),
    ]
)

# Fixed value: whole-second timestamps whose closing Z is read as UTC.
TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ssX"

# The layouts of events, sessions and series.
EVENT_COLUMNS = (
    "user_id",
    "started_at",
    "artist_id",
    "artist_name",
    "track_id",
    "track_name",
    "song_id",
)

SESSION_COLUMNS = (
    "user_id",
    "track_count",
    "session_start",
    "session_end",
    "session_number",
    "session_id",
    "session_duration_seconds",
    "session_duration_minutes",
)

SERIES_METRICS = ("session_count", "avg_session_duration_minutes")

# The model's inputs, in coefficient order after the intercept.
FEATURES = (
    "time_index",
    "month_sin",
    "month_cos",
    "lag_1",
    "lag_2",
    "lag_3",
    "rolling_mean_3",
)


def as_events(
    table: DataFrame,
    *,
    user_id,
    started_at,
    artist_id=None,
    artist_name=None,
    track_id=None,
    track_name=None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Map any timestamped table onto the event layout.

    Each argument is a column or column name; absent ones become null strings.
    Zone-less times are UTC. ``keep`` names further columns to carry along, such as a unique key used
    to order events that share a timestamp.
    """

    def text(value):
        return F.lit(None).cast("string") if value is None else _column(value).cast("string")

    return table.select(
        _column(user_id).alias("user_id"),
        _instant(table, _column(started_at)).alias("started_at"),
        text(artist_id).alias("artist_id"),
        text(artist_name).alias("artist_name"),
        text(track_id).alias("track_id"),
        text(track_name).alias("track_name"),
        F.coalesce(text(track_id), text(track_name)).alias("song_id"),
        *keep,
    )


def _instant(table: DataFrame, moment: Column) -> Column:
    """Zone-less times and dates are UTC; texts are read by the session."""
    kind = table.select(moment).schema[0].dataType
    return utc_instant(moment) if isinstance(kind, (T.TimestampNTZType, T.DateType)) else moment.cast("timestamp")


def _column(value):
    return F.col(value) if isinstance(value, str) else value
