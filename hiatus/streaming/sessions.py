"""Sessions over a stream of event files.

A session number can't be known on a stream, where an earlier session may still be
open, so a session's key is (user_id, session_start). A session is emitted once, when the
watermark has passed its last event by the gap: then no event that is in time can
extend it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hiatus.functions import duration_columns, gap_to_micros, utc_instant
from hiatus.operators.sessions import DEFAULT_GAP_MINUTES


def read_event_files(spark: SparkSession, path: str, schema: T.StructType, *, files_per_batch: int = 1_000) -> DataFrame:
    """A stream of the Parquet files below ``path``, zone-less times read as UTC."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    zoneless = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return rows.withColumns({name: utc_instant(F.col(name)) for name in zoneless})


def closed_sessions(
    events: DataFrame, gap_minutes: float = DEFAULT_GAP_MINUTES, delay: str = "1 hour"
) -> DataFrame:
    """One row per session that the watermark has closed; needs only user and time columns.

    Events may come up to ``delay`` after the latest event seen; later ones are left out.
    A pause of exactly the gap doesn't end a session, as in the batch operators.
    Rows without a time belong to no session. Needs append mode.
    """
    gap = f"{gap_to_micros(gap_minutes)} microseconds"
    timed = events.filter(F.col("started_at").isNotNull()).withWatermark("started_at", delay)
    sessions = timed.groupBy("user_id", F.session_window("started_at", gap)).agg(
        F.count(F.lit(1)).alias("track_count"),
        F.min("started_at").alias("session_start"),
        F.max("started_at").alias("session_end"),
    )
    durations = duration_columns(F.col("session_start"), F.col("session_end"))
    return sessions.select("user_id", "track_count", "session_start", "session_end", *durations)


def write_closed_sessions(
    events: DataFrame,
    path: str,
    checkpoint: str,
    gap_minutes: float = DEFAULT_GAP_MINUTES,
    delay: str = "1 hour",
) -> StreamingQuery:
    """Appends the sessions closed by the files there are now to Parquet under ``path``.

    Returns when they are written. Open sessions stay in the state below
    ``checkpoint``; the next call with it goes on from there with new files, also after
    a failure, and writes no session twice.
    """
    query = (
        closed_sessions(events, gap_minutes, delay)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
