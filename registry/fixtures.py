"""The given tables, mapped onto the event layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiatus.schema import as_events
from hiatus.sources import read_staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_staged(spark, f"{sf_dir}/{name}.parquet")


def _ids(events: DataFrame) -> DataFrame:
    """Deterministic artist and track ids, some missing and some ambiguous."""
    number = F.get_json_object("props", "$.k")
    odd = (F.col("event_id") % 2).cast("string")
    artist = (
        F.when(F.col("event_id") % 31 == 0, None)
        .when(F.col("event_type") == "error", F.concat(F.lit("error-"), odd))
        .otherwise(F.concat(F.lit("id-"), "event_type"))
    )
    track = F.concat_ws("-", "event_type", "number")
    return events.withColumn("number", number).withColumns(
        {
            "artist_id": artist,
            "track_id": F.when(F.col("event_id") % 9 == 0, None)
            .when(F.col("number").cast("int") % 10 == 0, F.concat(track, F.lit("-"), odd))
            .otherwise(track),
        }
    )


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events: every row usable, sub-second times, unique ``event_id``."""
    return as_events(
        _ids(table(spark, sf_dir, "events")),
        user_id="user_id",
        started_at="ts",
        artist_id="artist_id",
        artist_name="event_type",
        track_id="track_id",
        track_name="number",
        keep=("event_id",),
    )


def raw_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped events as a delimited file would give them, with bad times and missing names."""
    event_id = F.col("event_id")
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return _ids(table(spark, sf_dir, "events")).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.when(event_id % 103 == 0, "bad").otherwise(clock).alias("started_at_raw"),
        "artist_id",
        F.when(event_id % 97 != 0, F.col("event_type")).alias("artist_name"),
        "track_id",
        F.when(event_id % 101 != 0, F.col("number")).alias("track_name"),
    )


def nation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events of the customer's nation: 25 users, whole-day times, years long."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return as_events(
        joined,
        user_id="c_nationkey",
        started_at="o_orderdate",
        artist_name="c_mktsegment",
        track_name="o_orderpriority",
        keep=("o_orderkey",),
    )
