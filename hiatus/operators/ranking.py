"""Rankings of sessions, songs and users.

All rankings are a sort with a limit, which Spark runs as a top-k per
partition followed by one merge of k rows each. Sort keys end in an id, so a
limit always keeps the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiatus.functions import slice_start
from hiatus.operators.ordering import positions
from hiatus.operators.sessions import session_table

# Up to this many ranked sessions are broadcast; longer lists are joined by shuffle.
BROADCAST_SESSIONS = 1_000
# Width of the join slices for longer lists. Any width gives the same result.
JOIN_SLICE_MICROS = 60 * 60 * 1_000_000

# Names of the results and the keys that rank them.
_SONG = ("artist_name", "track_name")


def _session_order() -> list[Column]:
    return [F.desc("track_count"), F.asc("session_start"), F.asc("user_id"), F.asc("session_id")]


def _song_order() -> list[Column]:
    return [F.desc("play_count"), F.desc("session_count"), *map(F.asc, _SONG)]


def top_sessions(sessions: DataFrame, count: int = 50) -> DataFrame:
    """Sessions with the most tracks, from a session table or from session rows."""
    return session_table(sessions).orderBy(*_session_order()).limit(count)


def top_users(sessions: DataFrame, count: int = 10) -> DataFrame:
    """Users with the most sessions, from a session table or from session rows."""
    per_user = session_table(sessions).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("session_count"),
        F.min("session_start").alias("first_session_start"),
        F.max("session_end").alias("last_session_end"),
    )
    return per_user.orderBy(F.desc("session_count"), F.asc("user_id")).limit(count)


def top_user(sessions: DataFrame) -> DataFrame:
    """The one user with the most sessions; no row when there are no sessions."""
    return top_users(sessions, 1)


def with_rank(frame: DataFrame, order: Sequence[Column], **options) -> DataFrame:
    """Position 1..n of the rows of any frame in an order, as a ``rank`` column.

    Options are those of :func:`hiatus.operators.ordering.totals_before`.
    """
    return positions(frame, order, "rank", **options)


def ranked_sessions(sessions: DataFrame, count: int = 50) -> DataFrame:
    return with_rank(top_sessions(sessions, count), _session_order())


def ranked_songs(songs: DataFrame) -> DataFrame:
    return with_rank(songs, _song_order())


def plays_per_user(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("play_count"))


def most_active_user(events: DataFrame) -> DataFrame:
    """The one user with the most events."""
    return plays_per_user(events).orderBy(F.desc("play_count"), F.asc("user_id")).limit(1)


def events_of(events: DataFrame, user) -> DataFrame:
    """Events of one user: a literal id, or a one-row frame holding it.

    A literal reaches the Parquet scan as a pushed filter.
    """
    if isinstance(user, DataFrame):
        return events.join(F.broadcast(user.select("user_id").limit(1)), "user_id", "left_semi")
    return events.filter(F.col("user_id") == user)


def first_events(
    events: DataFrame, user, count: int = 40, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The earliest events of one user."""
    return events_of(events, user).orderBy("started_at", *tie_break).limit(count)


def plays_by_session_id(sessionized: DataFrame, ranked: DataFrame, count: int) -> DataFrame:
    """Events that belong to one of ``count`` ranked sessions, matched on session id."""
    chosen = ranked.select("session_id")
    if count <= BROADCAST_SESSIONS:
        chosen = F.broadcast(chosen)
    return sessionized.join(chosen, "session_id", "left_semi")


def plays_by_interval(events: DataFrame, ranked: DataFrame, count: int) -> DataFrame:
    """Events inside one of ``count`` ranked sessions, matched on user and time.

    Sessions of a user do not overlap, so an event matches at most one. Short
    lists are broadcast. For longer ones each session is spread over the time
    slices it covers and joined on (user, slice), which splits a busy user's
    events over many tasks.
    """
    bounds = ranked.select("user_id", "session_id", "session_start", "session_end")
    moments = events
    same = F.col("e.user_id") == F.col("s.user_id")
    if count <= BROADCAST_SESSIONS:
        bounds = F.broadcast(bounds)
    else:
        covered = F.sequence(
            slice_start(F.col("session_start"), JOIN_SLICE_MICROS),
            slice_start(F.col("session_end"), JOIN_SLICE_MICROS),
            F.lit(JOIN_SLICE_MICROS).cast("long"),
        )
        bounds = bounds.withColumn("slice_start", F.explode(covered))
        moments = events.withColumn(
            "slice_start", slice_start(F.col("started_at"), JOIN_SLICE_MICROS)
        )
        same = same & (F.col("e.slice_start") == F.col("s.slice_start"))
    inside = F.col("e.started_at").between(F.col("s.session_start"), F.col("s.session_end"))
    joined = moments.alias("e").join(bounds.alias("s"), same & inside)
    return joined.select(*[F.col(f"e.{name}") for name in events.columns], "s.session_id")


def song_counts(plays: DataFrame) -> DataFrame:
    """Plays, sessions and distinct track ids per (artist, track); null ids are not counted.

    Plays are first combined by song, session and id, before their one shuffle. The
    sessions of a song and its ids are then each counted by a plain aggregate, where two
    distinct counts side by side would copy every row.
    """
    combined = plays.groupBy(*_SONG, "session_id", "track_id").agg(F.count(F.lit(1)).alias("plays"))

    def counted(ident: str) -> DataFrame:
        each = combined.groupBy(*_SONG, ident).agg(F.sum("plays").alias("plays"))
        there = F.col(ident).isNotNull().cast("long")
        none = F.lit(0).cast("long")
        by = {"session_id": none, "track_id": none} | {ident: there}
        return each.select(*_SONG, "plays", by["session_id"].alias("sessions"), by["track_id"].alias("ids"))

    # Either part has all plays. Asking both for them keeps both on the same shuffle.
    both = counted("session_id").unionByName(counted("track_id"))
    summed = both.groupBy(*_SONG).agg(F.sum("plays").alias("plays"), F.sum("sessions").alias("session_count"), F.sum("ids").alias("distinct_track_ids"))
    return summed.select(*_SONG, (F.col("plays") / 2).cast("long").alias("play_count"), "session_count", "distinct_track_ids")


def top_songs(plays: DataFrame, count: int = 10) -> DataFrame:
    """Most played songs among events that carry a session id."""
    return song_counts(plays).orderBy(*_song_order()).limit(count)
