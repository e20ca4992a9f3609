from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from hiatus.schema import as_events

TEST_TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("hiatus-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    """Builds an event frame from (user, time text, artist, track, track id) rows."""

    def build(*rows):
        padded = [
            (index, *row, *[None] * (5 - len(row))) for index, row in enumerate(rows)
        ]
        table = spark.createDataFrame(
            padded,
            "event_id long, user string, clock string, artist string, track string, id string",
        )
        return as_events(
            table,
            user_id="user",
            started_at="clock",
            artist_name="artist",
            track_name="track",
            track_id="id",
            keep=("event_id",),
        )

    return build
