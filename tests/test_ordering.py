from __future__ import annotations

import os

from pyspark.sql import functions as F

from hiatus.operators.ordering import positions, totals_before
from hiatus.sources.workspace import Workspace


def test_positions_and_totals_in_several_ranges(spark):
    rows = spark.range(0, 50_000, numPartitions=8).withColumn("size", F.col("id") % 7)
    found = positions(rows, [F.desc("id")], ranges=16)
    assert found.where(F.col("rank") != 50_000 - F.col("id")).isEmpty() and found.count() == 50_000
    sums = totals_before(rows, [F.asc("id")], {"before": F.col("size")}, ranges=16)
    by_id = {r.id: r.before for r in sums.where("id % 4999 = 0").collect()}
    assert by_id == {i: sum(k % 7 for k in range(i)) for i in by_id}


def test_nulls_first_and_no_rows(spark):
    rows = spark.createDataFrame([(None, "b"), (3, "a"), (1, "c")], "k long, v string")
    found = {r.v: r.rank for r in positions(rows, [F.asc_nulls_first("k")]).collect()}
    assert found == {"b": 1, "c": 2, "a": 3}
    assert positions(rows.limit(0), [F.asc("k")]).collect() == []


def test_workspace_frees_its_tables(spark, tmp_path):
    with Workspace(spark, str(tmp_path)) as space:
        kept = space.write(spark.range(100_000).withColumn("x", F.rand(1)), "numbers")
        assert kept.count() == 100_000
        assert len(space.paths) == 1
    left = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(tmp_path) for f in names)
    assert left < 10_000 and space.paths == []


def test_workspace_survives_an_error_inside(spark, tmp_path):
    space = Workspace(spark, str(tmp_path))
    try:
        with space:
            space.write(spark.range(10))
            raise KeyError("stop")
    except KeyError:
        pass
    assert space.paths == []
