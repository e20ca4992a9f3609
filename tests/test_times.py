"""Zone-less times are UTC in any session zone, also where its clock jumps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hiatus.functions import utc_clock, utc_instant
from hiatus.operators.profile import plays_per_month
from hiatus.schema import as_events
from hiatus.sources.staged import read_staged

CLOCKS = {
    "2023-11-05 06:30:00": 1699165800,
    "2023-11-05 05:30:00": 1699162200,
    "2023-03-12 02:30:00": 1678588200,
    "2023-03-26 01:30:00.5": 1679794200.5,
    "1969-12-31 23:59:59.999999": -0.000001,
    "1883-11-18 12:02:00": -2717668680,
}


@pytest.fixture(params=["UTC", "America/New_York", "Europe/Berlin", "Asia/Kolkata"])
def zoned(request, spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def clocks(spark):
    rows = [(text,) for text in CLOCKS]
    return spark.createDataFrame(rows, "text string").withColumn("clock", F.col("text").cast("timestamp_ntz"))


def micros(frame, column):
    found = frame.select("text", F.unix_micros(column).alias("m")).collect()
    return {r.text: r.m for r in found}


EXPECTED = {text: round(seconds * 1_000_000) for text, seconds in CLOCKS.items()}


def test_instants_and_back(zoned):
    frame = clocks(zoned).withColumn("instant", utc_instant(F.col("clock")))
    assert micros(frame, "instant") == EXPECTED
    assert frame.where(utc_clock(F.col("instant")) != F.col("clock")).isEmpty()
    assert utc_instant_of_null(zoned) is None


def utc_instant_of_null(spark):
    return spark.sql("SELECT cast(null AS timestamp_ntz) AS c").select(utc_instant(F.col("c"))).first()[0]


def test_staged_files(zoned, tmp_path):
    path = str(tmp_path / "clocks")
    clocks(zoned).write.parquet(path)
    assert micros(read_staged(zoned, path), "clock") == EXPECTED


def test_events_of_zoneless_times_and_dates(zoned):
    events = as_events(clocks(zoned), user_id=F.lit(1), started_at="clock", keep=("text",))
    assert micros(events, "started_at") == EXPECTED
    dated = as_events(zoned.sql("SELECT date'2024-03-31' AS d"), user_id=F.lit(1), started_at="d")
    assert dated.select(F.unix_micros("started_at")).first()[0] == 1711843200000000


def test_months_are_those_of_utc(zoned):
    frame = zoned.sql("SELECT timestamp_ntz'2024-01-31 23:30:00' AS c UNION ALL SELECT timestamp_ntz'2024-02-01 00:30:00'")
    months = plays_per_month(as_events(frame, user_id=F.lit(1), started_at="c"))
    assert [utc for (utc,) in months.select(F.unix_micros(months.columns[0])).orderBy(1).collect()] == [1704067200000000, 1706745600000000]
