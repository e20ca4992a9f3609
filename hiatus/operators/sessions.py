"""Sessions: runs of a user's events with no pause longer than a gap.

A window over all events of a user puts the whole user on one task, which
fails when one user holds a large share of the rows. Both operators here work
on *slices* instead: fixed time slices exactly one gap wide.

Two events in the same slice are less than one gap apart, so a slice never
contains a session boundary. Every boundary can be found by comparing a slice's
first event with the last event of the user's previous non-empty slice. A plain
hash aggregate (combined on the map side) reduces the events to one row per
(user, slice), and the per-user window then sees at most ``time span / gap``
rows per user however many events there are: 26,280 a year at 20 minutes.

With gaps so small that nearly every event is a slice of its own, slices are
numbered inside blocks of 512, blocks inside blocks of 512 blocks, and so on until
blocks are wide enough for the per-user window. That window's length then
depends on the time span alone, whatever the gap. The events are read once: every
level starts from the shuffle of the one below, which Spark reuses.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hiatus.functions import duration_columns, gap_to_micros, session_id, slice_start, whole_seconds
from hiatus.schema import SESSION_COLUMNS

DEFAULT_GAP_MINUTES = 20

# Rows are numbered in blocks of this many slices.
SLICES_PER_BLOCK = 512
# Slices or blocks at least this wide are numbered per user: 262,980 a year at most.
USER_WINDOW_MICROS = 120_000_000
# Blocks with more rows are cut into cells, at this many quantiles of their times. Such
# blocks, and with them the broadcast list of cells, are at most total / BLOCK_ROWS. With
# fewer rows asked for, there may be as many as rows, and the list is joined by shuffle.
BLOCK_ROWS = 5_000_000
CUTS = 64

# What a row is numbered with: its block and, in a crowded block, its cell and its part.
_PLACE = ("_block", "_cell", "_part")

def session_slices(events: DataFrame, gap_minutes: float = DEFAULT_GAP_MINUTES) -> DataFrame:
    """One row per (user, non-empty slice), numbered with the session it belongs to.

    ``events_before`` is the number of the user's events in earlier slices.
    """
    gap = gap_to_micros(gap_minutes)
    slices = (
        events.filter(F.col("started_at").isNotNull())
        .groupBy("user_id", _slice_of(gap).alias("slice_start"))
        .agg(
            F.count(F.lit(1)).alias("track_count"),
            F.min("started_at").alias("first_event"),
            F.max("started_at").alias("last_event"),
        )
    )
    return _numbered(slices.withColumn("boundaries", F.lit(0)), max(gap, 1), gap).drop("boundaries")


def _numbered(slices: DataFrame, width: int, gap: int) -> DataFrame:
    """Adds what comes before each (user, slice), and its first event's session number.

    ``boundaries`` are the session starts in a slice other than at its first event.
    Narrow slices are numbered inside wider blocks, which are numbered in the same
    way; what precedes a block then completes the numbers of its slices. Slices and
    their blocks need the same columns, and no filter is derived from a null-safe join,
    so both come from one shuffle and the events are not read again.
    """
    opens = _opens("first_event", "previous_event", gap)
    if width >= USER_WINDOW_MICROS:
        in_time = Window.partitionBy("user_id").orderBy("slice_start")
        started = F.sum(opens + F.col("boundaries")).over(_up_to_here(in_time))
        return slices.withColumn("previous_event", F.lag("last_event").over(in_time)).withColumns(
            {
                "opens_session": opens,
                "session_number": started - F.col("boundaries"),
                "events_before": _events_before(in_time),
            }
        )

    wider = width * SLICES_PER_BLOCK
    block = F.col("slice_start") - F.pmod("slice_start", F.lit(wider).cast("long"))
    in_block = Window.partitionBy("user_id", "block").orderBy("slice_start")
    # The start of a block's first event is counted by the block.
    later = F.when(F.col("previous_event").isNull(), 0).otherwise(opens)
    started = F.sum(F.col("opens_session") + F.col("boundaries")).over(_up_to_here(in_block))
    inside = (
        slices.withColumn("block", block)
        .withColumn("previous_event", F.lag("last_event").over(in_block))
        .withColumn("opens_session", later)
        .withColumn("session_number", started - F.col("boundaries"))
        .withColumn("events_before", _events_before(in_block))
    )
    blocks = inside.groupBy("user_id", F.col("block").alias("slice_start")).agg(
        F.sum("track_count").alias("track_count"),
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
        F.sum(F.col("opens_session") + F.col("boundaries")).alias("boundaries"),
    )
    around = _numbered(blocks, wider, gap)
    same_block = F.col("inside.user_id").eqNullSafe(F.col("around.user_id")) & (
        F.col("inside.block").eqNullSafe(F.col("around.slice_start"))
    )
    at_edge = F.col("inside.previous_event").isNull()
    return (
        inside.alias("inside")
        .join(around.alias("around"), same_block)
        .select(
            *[F.col(f"inside.{name}") for name in slices.columns],
            F.coalesce("inside.previous_event", "around.previous_event").alias("previous_event"),
            F.when(at_edge, F.col("around.opens_session"))
            .otherwise(F.col("inside.opens_session"))
            .alias("opens_session"),
            (F.col("around.session_number") + F.col("inside.session_number")).alias("session_number"),
            (F.col("around.events_before") + F.col("inside.events_before")).alias("events_before"),
        )
    )


def _events_before(ordered: WindowSpec) -> Column:
    return F.sum("track_count").over(_up_to_here(ordered)) - F.col("track_count")


def _events_in() -> Column:
    """The events of a user's consecutive slices, from where they begin and end in its history."""
    return F.max(F.col("events_before") + F.col("track_count")) - F.min("events_before")


def summarize_events(events: DataFrame, gap_minutes: float = DEFAULT_GAP_MINUTES) -> DataFrame:
    """One row per session, straight from events; needs only user and time columns."""
    merged = (
        session_slices(events, gap_minutes)
        .groupBy("user_id", "session_number")
        .agg(
            _events_in().alias("track_count"),
            F.min("first_event").alias("session_start"),
            F.max("last_event").alias("session_end"),
        )
        .withColumn("session_id", session_id(F.col("user_id"), F.col("session_number")))
    )
    return _with_duration(merged)


def summarize_sessionized(sessionized: DataFrame) -> DataFrame:
    """The same table as :func:`summarize_events`, from event rows that carry a session id.

    Rows without ``session_number`` get their sessions numbered per user by start.
    """
    numbered = "session_number" in sessionized.columns
    keys = ("user_id", "session_id", *(["session_number"] if numbered else []))
    grouped = sessionized.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("track_count"),
        F.min("started_at").alias("session_start"),
        F.max("started_at").alias("session_end"),
    )
    if not numbered:
        order = Window.partitionBy("user_id").orderBy("session_start", "session_id")
        grouped = grouped.withColumn("session_number", F.row_number().over(order).cast("long"))
    return _with_duration(grouped)


def session_table(sessions: DataFrame) -> DataFrame:
    """A session table as it is, or that of event rows which carry a session id."""
    return sessions if "track_count" in sessions.columns else summarize_sessionized(sessions)


def sessionize(
    events: DataFrame,
    gap_minutes: float = DEFAULT_GAP_MINUTES,
    tie_break: Sequence[str] = (),
    *,
    block_rows: int = BLOCK_ROWS,
    within: DataFrame | None = None,
    few: bool = False,
) -> DataFrame:
    """Event rows with pause, session flag, previous event time, session number and id.

    ``tie_break`` names columns ordering events that share a timestamp; without
    it the row flagged as first among such events is arbitrary, as is the order
    of exact copies. Session numbers and ids never depend on it.

    Rows are shuffled once, by user and time block. The slice table tells each block its
    previous event and how many sessions came before, so blocks of a user are
    numbered independently. Blocks of more than ``block_rows`` rows are cut into cells at
    quantiles of their times, which are told the same. An instant that
    takes more than one quantile is a cell of its own, whose rows are dealt over parts:
    what comes first there is known beforehand, so the others need no order. Only exact
    copies of the first row of such an instant stay together.

    ``within`` is a table of sessions of the same events and gap, or a part of it: only
    the blocks that these sessions touch are shuffled, numbered and returned, with the
    numbers they have among all events. ``few`` says that its rows may be broadcast.
    """
    gap = gap_to_micros(gap_minutes)
    timed = events.filter(F.col("started_at").isNotNull()).withColumn("_block", _block_of(gap))
    slices = session_slices(events, gap_minutes)
    blocks = _blocks(slices, gap)
    crowded = F.col("track_count") > block_rows
    cut, rows = blocks.filter(crowded), timed
    if within is not None:
        cut, rows = (_touched(frame, within, gap, few) for frame in (cut, timed))
    first = [*tie_break, F.xxhash64(*_hashable(events))]
    cells = _cells(timed, cut, slices, gap, first, block_rows)
    placed = _placed(rows, cells, first, block_rows)
    numbered = _number_rows(placed, blocks.filter(~crowded), gap, tie_break)
    return numbered.select(
        *events.columns,
        _pause_seconds().alias("gap_seconds"),
        "is_new_session",
        "previous_started_at",
        "session_number",
        session_id(F.col("user_id"), F.col("session_number")).alias("session_id"),
    )


def _hashable(events: DataFrame) -> list[str]:
    return [f.name for f in events.schema.fields if f.dataType.typeName() not in ("map", "variant")]


def _block_of(gap: int) -> Column:
    return slice_start(F.col("started_at"), max(gap, 1) * SLICES_PER_BLOCK)


def _blocks(slices: DataFrame, gap: int) -> DataFrame:
    """What precedes each (user, block): the last event and the number of sessions."""
    start = F.col("slice_start")
    block = start - F.pmod(start, F.lit(max(gap, 1) * SLICES_PER_BLOCK).cast("long"))
    already_open = F.col("session_number") - F.col("opens_session")
    return slices.groupBy("user_id", block.alias("_block")).agg(
        _events_in().alias("track_count"),
        F.min_by("previous_event", "slice_start").alias("previous_event"),
        F.min(already_open).alias("sessions_before"),
    )


def _touched(placed: DataFrame, sessions: DataFrame, gap: int, few: bool) -> DataFrame:
    """Rows of the (user, block) places that at least one of the sessions touches.

    Few sessions are broadcast with their first and last block; many are spread
    over their blocks, at most one for every 512 of a session's events and two more.
    """
    width = max(gap, 1) * SLICES_PER_BLOCK
    first, last = (slice_start(F.col(name), width) for name in ("session_start", "session_end"))
    if few:
        spans = F.broadcast(sessions.select("user_id", first.alias("_first"), last.alias("_last")))
        inside = F.col("placed._block").between(F.col("spans._first"), F.col("spans._last"))
        user = F.col("placed.user_id").eqNullSafe(F.col("spans.user_id"))
        return placed.alias("placed").join(spans.alias("spans"), user & inside, "left_semi")
    blocks = F.sequence(first, last, F.lit(width).cast("long"))
    spans = sessions.select("user_id", F.explode(blocks).alias("_block")).distinct()
    return placed.alias("placed").join(spans.alias("spans"), _same("placed", "spans"), "left_semi")


def _per_block(frame: DataFrame, block_rows: int) -> DataFrame:
    """A row for each crowded block, to be joined to events: broadcast if they are few for sure."""
    return F.broadcast(frame) if block_rows >= BLOCK_ROWS else frame


def _begun(rows: DataFrame, start_of: Callable[[Column], Column]) -> DataFrame:
    """Adds how many of a block's cells, in order of time, have begun at a row's time; found by halving."""
    found = F.col("_begun")
    rows = rows.withColumn("_begun", F.lit(0))
    for power in reversed(range(CUTS.bit_length())):
        further = found + (1 << power)
        reached = start_of(further - 1) <= F.unix_micros("started_at")
        rows = rows.withColumn("_begun", F.when(reached, further).otherwise(found))
    return rows


def _cells(
    timed: DataFrame, crowded: DataFrame, slices: DataFrame, gap: int, first: list, block_rows: int
) -> DataFrame:
    """For each crowded block its cells: where they begin (in microseconds) and what precedes them.

    ``parts`` is 0 but for a cell that is a single crowded instant, of which ``leader`` is
    the least row. No row is read when no block is crowded.
    """
    shares = [(k + 1) / CUTS for k in range(CUTS - 1)]
    quantiles = F.percentile_approx(F.unix_micros("rows.started_at"), shares, 10_000)
    rows = timed.alias("rows").join(_per_block(crowded, block_rows).alias("blocks"), _same("rows", "blocks"))
    cuts = rows.groupBy("rows.user_id", "rows._block").agg(
        quantiles.alias("_quantiles"), F.max("blocks.previous_event").alias("_previous")
    )
    # Quantiles ascend, so equal ones are neighbours.
    again = F.filter("_quantiles", lambda q, k: q == F.get("_quantiles", k - 1))
    cuts = cuts.select(
        "user_id",
        "_block",
        "_previous",
        "_quantiles",
        F.sort_array(F.array_distinct(F.concat("_quantiles", F.transform(again, lambda q: q + 1)))).alias("_cuts"),
    )
    joined = timed.alias("rows").join(_per_block(cuts, block_rows).alias("cuts"), _same("rows", "cuts"))
    begun = _begun(
        joined.select("rows.*", "cuts._previous", "cuts._quantiles", "cuts._cuts"), lambda k: F.get("_cuts", k)
    )
    own = F.coalesce(F.get("_cuts", F.col("_begun") - 1), "_block")
    # How many quantiles are the instant at which the cell begins: from the first of them to the last.
    last = F.size("_quantiles") + 1 - F.array_position(F.reverse("_quantiles"), F.col("_cell"))
    taken = last - F.array_position("_quantiles", F.col("_cell")) + 1
    parts = F.when(F.array_contains("_quantiles", F.col("_cell")) & (taken > 1), taken).otherwise(0)
    counted = (
        begun.withColumn("_cell", own)
        .withColumn("_parts", parts)
        .groupBy("user_id", "_block", F.col("_cell").alias("cell"))
        .agg(
            F.min("started_at").alias("first_event"),
            F.max("started_at").alias("last_event"),
            F.max("_parts").alias("parts"),
            F.max("_previous").alias("block_previous"),
            F.min(F.when(F.col("_parts") > 0, F.struct(*first))).alias("leader"),
        )
    )
    in_block = Window.partitionBy("user_id", "_block").orderBy("cell")
    before = F.coalesce(F.lag("last_event").over(in_block), "block_previous")
    # A session number is that of the slice; the cell's first event may be what opens it.
    numbers = slices.select("user_id", "slice_start", "session_number").alias("slices")
    same_slice = F.col("cells.user_id").eqNullSafe(F.col("slices.user_id")) & (
        slice_start(F.col("cells.first_event"), max(gap, 1)) == F.col("slices.slice_start")
    )
    opens = _opens("first_event", "previous_event", gap)
    return (
        counted.withColumn("previous_event", before)
        .alias("cells")
        .join(numbers, same_slice)
        .groupBy("cells.user_id", "cells._block")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "cell",
                        "parts",
                        "leader",
                        "previous_event",
                        (F.col("session_number") - opens).alias("sessions_before"),
                        F.col("session_number").alias("sessions_after"),
                    )
                )
            ).alias("_cells")
        )
    )


def _placed(timed: DataFrame, cells: DataFrame, first: list, block_rows: int) -> DataFrame:
    """Rows with the cell and the part they are numbered in, and what precedes it.

    Outside of crowded blocks these are null. In the first part of a crowded instant
    are the copies of its first row, after which the instant has begun in all others.
    """
    dealt = F.pmod(F.monotonically_increasing_id(), F.col("_own.parts")) + 1
    begun = (F.col("_own.parts") > 0) & (F.struct(*first) != F.col("_own.leader"))
    joined = timed.alias("rows").join(_per_block(cells, block_rows).alias("cells"), _same("rows", "cells"), "left")
    placed = _begun(joined.select("rows.*", "_cells"), lambda k: F.get("_cells", k)["cell"])
    placed = placed.withColumn("_own", F.get("_cells", F.col("_begun") - 1))
    return placed.select(
        *timed.columns,
        F.col("_own.cell").alias("_cell"),
        F.when(begun, dealt).alias("_part"),
        F.when(begun, F.col("started_at")).otherwise(F.col("_own.previous_event")).alias("_previous"),
        F.when(begun, F.col("_own.sessions_after")).otherwise(F.col("_own.sessions_before")).alias("_sessions"),
    )


def _number_rows(rows: DataFrame, blocks: DataFrame, gap: int, tie_break: Sequence[str]) -> DataFrame:
    """Previous event, session flag and session number for rows, place by place.

    ``blocks`` has one row per (user, block) with what precedes it. That row is
    sorted ahead of the block's events as a marker, so one sort serves the lag
    and the running count, and null users match as well. Rows of cut blocks know
    themselves what precedes their place.
    """
    markers = blocks.select(
        "user_id",
        "_block",
        F.lit(0).alias("_rank"),
        F.col("previous_event").alias("_clock"),
        F.col("sessions_before").alias("_sessions"),
    )
    marked = rows.withColumns({"_rank": F.lit(1), "_clock": F.col("started_at")}).unionByName(
        markers, allowMissingColumns=True
    )
    ordered = Window.partitionBy("user_id", *_PLACE).orderBy("_rank", "started_at", *tie_break)
    opens = _opens("started_at", "previous_started_at", gap)
    # Of a marker its sessions; of a row of a cut block they are added to the sum.
    opened = F.when(F.col("_rank") == 0, F.col("_sessions")).otherwise(opens)
    before = F.when(F.col("_rank") == 1, F.coalesce("_sessions", F.lit(0))).otherwise(0)
    return (
        marked.withColumn("previous_started_at", F.coalesce(F.lag("_clock").over(ordered), "_previous"))
        .withColumns(
            {
                "is_new_session": opens,
                "session_number": F.sum(opened).over(_up_to_here(ordered)) + before,
            }
        )
        .filter(F.col("_rank") == 1)
    )


def _slice_of(gap: int) -> Column:
    return slice_start(F.col("started_at"), max(gap, 1))


def _opens(event: str, previous: str, gap: int) -> Column:
    """1 if ``event`` is more than a gap after ``previous``, or nothing came before it."""
    pause = F.unix_micros(event) - F.unix_micros(previous)
    return F.when(F.col(previous).isNull() | (pause > gap), F.lit(1)).otherwise(F.lit(0))


def _up_to_here(ordered: WindowSpec) -> WindowSpec:
    return ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _pause_seconds() -> Column:
    return whole_seconds(F.col("started_at")) - whole_seconds(F.col("previous_started_at"))


def _same(left: str, right: str) -> Column:
    """Null-safe in both columns: no filter is derived, and joins of the same rows share a shuffle."""
    return F.col(f"{left}.user_id").eqNullSafe(F.col(f"{right}.user_id")) & (
        F.col(f"{left}._block").eqNullSafe(F.col(f"{right}._block"))
    )


def _with_duration(sessions: DataFrame) -> DataFrame:
    durations = duration_columns(F.col("session_start"), F.col("session_end"))
    return sessions.select("*", *durations).select(*SESSION_COLUMNS)
