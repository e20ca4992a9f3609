"""Session analyses composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from hiatus.operators import ranking
from hiatus.operators.sessions import (
    DEFAULT_GAP_MINUTES,
    sessionize,
    summarize_events,
    summarize_sessionized,
)
from hiatus.sources import load_events
from hiatus.sources.workspace import Workspace


def top_songs_in_top_sessions(
    events: DataFrame,
    sessions: DataFrame | None = None,
    session_count: int = 50,
    song_count: int = 10,
    *,
    gap_minutes: float | None = None,
) -> DataFrame:
    """Most played songs inside the sessions with the most tracks.

    Rows that already carry a session id are matched on it; plain events need the
    session table and are matched by user and time. Given the gap of that table they are
    numbered and matched on session id, which numbers only the blocks of chosen sessions.
    """
    if "session_id" in events.columns:
        table = summarize_sessionized(events) if sessions is None else sessions
        chosen = ranking.top_sessions(table, session_count)
        plays = ranking.plays_by_session_id(events, chosen, session_count)
    elif sessions is None:
        raise ValueError("events without a session_id column need the sessions table")
    elif gap_minutes is not None:
        chosen = ranking.top_sessions(sessions, session_count)
        few = session_count <= ranking.BROADCAST_SESSIONS
        rows = sessionize(events, gap_minutes, within=chosen, few=few)
        plays = ranking.plays_by_session_id(rows, chosen, session_count)
    else:
        chosen = ranking.top_sessions(sessions, session_count)
        plays = ranking.plays_by_interval(events, chosen, session_count)
    return ranking.top_songs(plays, song_count)


def materialize(frame: DataFrame) -> DataFrame:
    """Keeps a frame that feeds several outputs on executor disks and fills it now.

    Lost blocks are recomputed from their inputs. Call ``unpersist`` when done.
    """
    kept = frame.persist(StorageLevel.DISK_ONLY)
    kept.count()
    return kept


@dataclass(frozen=True)
class SessionFrames:
    events: DataFrame
    sessions: DataFrame
    sessionized: DataFrame | None = None


def prepare(
    spark: SparkSession,
    tsv_path: str,
    staged_path: str | None = None,
    gap_minutes: float = DEFAULT_GAP_MINUTES,
    *,
    refresh: bool = False,
    partitions: int | None = None,
    with_rows: bool = False,
    tie_break: Sequence[str] = (),
    quote: str | None = None,
    format: str | None = None,
    workspace: Workspace | None = None,
) -> SessionFrames:
    """Load (and stage) events and materialise their session table.

    With a ``workspace`` the table is written there, which outlives lost executors and
    ends with the workspace; otherwise executors keep it on their disks.
    """
    events = load_events(
        spark, tsv_path, staged_path, refresh=refresh, partitions=partitions, quote=quote, format=format
    )
    rows = sessionize(events, gap_minutes, tie_break) if with_rows else None
    sessions = summarize_events(events, gap_minutes)
    kept = materialize(sessions) if workspace is None else workspace.write(sessions, "sessions")
    return SessionFrames(events, kept, rows)
