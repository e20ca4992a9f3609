"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiatus.llm.tables import written


def connected(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every linked node; root is the smallest node reachable.

    Alternates the large-star and small-star steps of Kiveris et al. until every
    link points at its root. A node's smallest neighbour is an aggregate combined
    before the shuffle, and it is joined back from a written table, so that the
    many links of a hub can be split over tasks. Links to oneself, repeated links
    and nulls are ignored; no links give no rows.
    """
    both = links.select(
        F.greatest(left, right).alias("node"), F.least(left, right).alias("root")
    ).where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
    stars = written(both.distinct(), "links")
    state = _state(stars)
    while state[0]:
        stars = written(_small_star(written(_large_star(stars), "links")), "links")
        before, state = state, _state(stars)
        if state == before:
            break
    return stars


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the node's smallest neighbour."""
    seen = links.select("node", F.col("root").alias("other")).union(
        links.select(F.col("root").alias("node"), F.col("node").alias("other"))
    )
    least = written(seen.groupBy("node").agg(F.min("other").alias("least")), "least")
    return (
        seen.where(F.col("other") > F.col("node"))
        .join(least, "node")
        .select(F.col("other").alias("node"), F.least("node", "least").alias("root"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = written(links.groupBy("node").agg(F.min("root").alias("least")), "least")
    moved = (
        links.join(least, "node")
        .where(F.col("root") != F.col("least"))
        .select(F.col("root").alias("node"), F.col("least").alias("root"))
    )
    return moved.union(least.select("node", F.col("least").alias("root"))).distinct()
