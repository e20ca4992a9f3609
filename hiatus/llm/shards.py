"""Comparing the members of a shard with its visitors in bounded pieces."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiatus.llm.tables import written

#: Members, and visitors, that one piece holds on average.
PIECE = 2048


def in_pieces(routed: DataFrame, keys: list[str], ident: str, piece: int = PIECE) -> DataFrame:
    """Deals each shard's rows over a grid of members by visitors.

    ``routed`` has one row for each shard that a row visits, with ``home`` true in
    the one it is a member of. A shard of m members and v visitors becomes
    (m / piece) x (v / piece) pieces, so a hot shard is spread over many tasks.
    Adds ``member_piece``, ``visitor_piece`` and ``member`` (the row's part here);
    group by ``keys`` and the first two. Shards without a pair are left out.
    """
    sizes = written(
        routed.groupBy(*keys)
        .agg(F.count_if("home").alias("_members"), F.count("*").alias("_visitors"))
        .where("_members > 0 AND _visitors > 1")
        .select(
            *keys,
            F.ceil(F.col("_members") / piece).cast("int").alias("_rows"),
            F.ceil(F.col("_visitors") / piece).cast("int").alias("_columns"),
        ),
        "shard-sizes",
    )
    dealt = routed.join(sizes, keys)
    hashed = F.xxhash64(ident)
    member_piece = F.pmod(hashed, F.col("_rows")).cast("int")
    visitor_piece = F.pmod(F.xxhash64(hashed), F.col("_columns")).cast("int")
    pieces = F.concat(
        F.when(
            F.col("home"),
            F.transform(
                F.sequence(F.lit(0), F.col("_columns") - 1),
                lambda other: F.struct(
                    member_piece.alias("member_piece"),
                    other.alias("visitor_piece"),
                    F.lit(True).alias("member"),
                ),
            ),
        ).otherwise(F.array().cast("array<struct<member_piece:int,visitor_piece:int,member:boolean>>")),
        F.transform(
            F.sequence(F.lit(0), F.col("_rows") - 1),
            lambda other: F.struct(
                other.alias("member_piece"),
                visitor_piece.alias("visitor_piece"),
                F.lit(False).alias("member"),
            ),
        ),
    )
    return dealt.withColumn("_piece", F.explode(pieces)).select(
        *[c for c in routed.columns if c != "home"], "_piece.*"
    )


def roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``count`` rows reaches over the links."""
    root = np.arange(count)
    while len(left):
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        root = new
        apart = root[left] != root[right]
        left, right = left[apart], right[apart]
    return root


class Stars:
    """Links between ``count`` rows, folded into stars as they come."""

    def __init__(self, count: int, most: int = 1 << 20):
        self.count, self.most = count, most
        self.left, self.right, self.held = [], [], 0

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        self.left.append(left)
        self.right.append(right)
        self.held += len(left)
        if self.held > self.most:
            root = self.root()
            moved = np.flatnonzero(root != np.arange(self.count))
            self.left, self.right, self.held = [moved], [root[moved]], len(moved)

    def root(self) -> np.ndarray:
        none = [np.zeros(0, dtype=np.int64)]
        return roots(self.count, np.concatenate(self.left or none), np.concatenate(self.right or none))
