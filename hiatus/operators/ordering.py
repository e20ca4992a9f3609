"""Positions and running totals in a global order, spread over tasks.

A window without a partition sorts all rows in one task. Here rows are dealt by
ranges of the order, each range is summed up inside its own task, and the totals of
the earlier ranges, one row for each range, complete them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Store = Callable[[DataFrame], DataFrame]


def persisted(frame: DataFrame) -> DataFrame:
    return frame.persist(StorageLevel.DISK_ONLY)


def totals_before(
    frame: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, Column],
    *,
    ranges: int | None = None,
    store: Store = persisted,
) -> DataFrame:
    """Adds, for each of ``totals``, the sum of its column over all earlier rows.

    ``order`` should end in an id: rows that are equal in all of its columns fall in
    one range and come in no particular order. Nulls count as 0. ``ranges`` are the
    tasks to use, the session's shuffle partitions by default. Range bounds come from
    a sample, so the dealt rows are read more than once and must be the same each
    time: ``store`` keeps them, on executor disks unless it writes a table.
    """
    names = list(totals)
    ranges = ranges or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = store(
        frame.repartitionByRange(ranges, *order).withColumns(
            {"_range": F.spark_partition_id(), **{f"_own_{n}": F.coalesce(totals[n], F.lit(0)) for n in names}}
        )
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # One row a range, whatever the number of rows.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_range").agg(*[F.sum(f"_own_{n}").alias(f"_all_{n}") for n in names])
    bases = sums.select("_range", *[F.coalesce(F.sum(f"_all_{n}").over(earlier), F.lit(0)).alias(f"_base_{n}") for n in names])
    summed = dealt.withColumns({n: F.coalesce(F.sum(f"_own_{n}").over(inside), F.lit(0)) for n in names})
    return summed.join(F.broadcast(bases), "_range").select(
        *[c for c in frame.columns if c not in totals],
        *[(F.col(n) + F.col(f"_base_{n}")).alias(n) for n in names],
    )


def positions(frame: DataFrame, order: Sequence[Column], name: str = "rank", **options) -> DataFrame:
    """Adds the position of each row in the order, from 1."""
    placed = totals_before(frame, order, {name: F.lit(1).cast("long")}, **options)
    return placed.withColumn(name, F.col(name) + 1)
