"""Name-to-id maps, their ambiguity, and how many missing ids they could fill."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiatus.functions import percentage


@dataclass(frozen=True)
class Identity:
    """An id column, the name columns that should determine it, and output names."""

    id_column: str
    names: tuple[str, ...]
    distinct_ids: str
    example_id: str
    unique_names: str
    ambiguous_names: str
    missing_rows: str
    recoverable_rows: str
    recoverable_rate: str


TRACK = Identity(
    id_column="track_id",
    names=("artist_name", "track_name"),
    distinct_ids="distinct_track_ids_for_name_pair",
    example_id="example_track_id",
    unique_names="unique_name_pairs",
    ambiguous_names="ambiguous_name_pairs",
    missing_rows="null_track_id_rows",
    recoverable_rows="exact_backfillable_null_track_rows",
    recoverable_rate="exact_backfillable_rate_pct_of_null_track_rows",
)

ARTIST = Identity(
    id_column="artist_id",
    names=("artist_name",),
    distinct_ids="distinct_artist_ids_for_name",
    example_id="example_artist_id",
    unique_names="unique_artist_names",
    ambiguous_names="ambiguous_artist_names",
    missing_rows="null_artist_id_rows",
    recoverable_rows="exact_backfillable_null_artist_rows",
    recoverable_rate="exact_backfillable_rate_pct_of_null_artist_rows",
)


def name_map(events: DataFrame, kind: Identity) -> DataFrame:
    """Per name: number of distinct ids and the smallest of them; a null name is its own group."""
    return (
        _names_with_ids(events.filter(F.col(kind.id_column).isNotNull()), kind)
        .groupBy(*kind.names)
        .agg(
            F.count(F.lit(1)).alias(kind.distinct_ids),
            F.min(kind.id_column).alias(kind.example_id),
        )
    )


def name_map_stats(events: DataFrame, kind: Identity) -> DataFrame:
    """One row: names with exactly one id, names with several."""
    ids_per_name = (
        _names_with_ids(events.filter(F.col(kind.id_column).isNotNull()), kind)
        .groupBy(*kind.names)
        .agg(F.count(F.lit(1)).alias("ids"))
    )
    return ids_per_name.agg(
        F.count_if(F.col("ids") == 1).alias(kind.unique_names),
        F.count_if(F.col("ids") > 1).alias(kind.ambiguous_names),
    )


def _names_with_ids(events: DataFrame, kind: Identity) -> DataFrame:
    """Each (name, id) pair once, with its rows.

    Counting is a hash aggregate combined before the shuffle, also for a name
    with a large share of the rows. A smallest or largest string cannot be kept
    in a hash aggregate and would sort all events, so those come after this step.
    """
    return events.groupBy(*kind.names, kind.id_column).agg(F.count(F.lit(1)).alias("rows"))


def ambiguous_names(events: DataFrame, kind: Identity, count: int = 20) -> DataFrame:
    """The names with the most ids, several each."""
    several = name_map(events, kind).filter(F.col(kind.distinct_ids) > 1)
    return several.orderBy(F.desc(kind.distinct_ids), *map(F.asc, kind.names)).limit(count)


def recoverable_rows(events: DataFrame, kind: Identity) -> DataFrame:
    """Events without an id whose name has exactly one, with that id beside them.

    The map has one row per name, so only the event side can be skewed. The
    hash makes the join exchange both sides itself instead of building on the
    map's aggregation, and AQE splits skewed partitions of such exchanges only.
    A null name matches nothing.
    """
    name_hash = F.xxhash64(*kind.names).alias("name_hash")
    unique = name_map(events, kind).filter(F.col(kind.distinct_ids) == 1)
    unique = unique.select(*kind.names, name_hash, kind.example_id)
    missing = events.filter(F.col(kind.id_column).isNull()).select("*", name_hash)
    return missing.join(unique, [*kind.names, "name_hash"]).select(
        *events.columns, kind.example_id
    )


def backfill_coverage(events: DataFrame, kind: Identity) -> DataFrame:
    """One row: events without an id, how many an exact name match recovers, and the rate.

    Counted from (name, id) pairs instead of joining the events to the map.
    """
    is_missing = F.col(kind.id_column).isNull()
    per_name = (
        _names_with_ids(events, kind)
        .groupBy(*kind.names)
        .agg(
            F.sum(F.when(is_missing, F.col("rows"))).alias("missing"),
            F.count(kind.id_column).alias("ids"),
        )
    )
    unique = F.col("ids") == 1
    for name in kind.names:
        unique = unique & F.col(name).isNotNull()
    nothing = F.lit(0).cast("long")
    totals = per_name.agg(
        F.coalesce(F.sum("missing"), nothing).alias(kind.missing_rows),
        F.coalesce(F.sum(F.when(unique, F.col("missing"))), nothing).alias(kind.recoverable_rows),
    )
    rate = percentage(F.col(kind.recoverable_rows), F.col(kind.missing_rows))
    return totals.withColumn(kind.recoverable_rate, rate)
