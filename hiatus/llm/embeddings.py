"""Near-duplicate embeddings by randomised-rotation binary codes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiatus.llm.components import connected
from hiatus.llm.shards import Stars, in_pieces
from hiatus.llm.tables import written

LEAST_COSINE = 0.95
#: Vectors that a bucket holds on average, and the chance at most that a pair
#: right at the least cosine shares no bucket (a closer pair's is smaller).
BUCKET, MISS = 512, 1e-6
#: Standard deviations that the estimate's bound lies away from it.
DEVIATIONS = 6.0
SEED = 29


def tables_for(vectors: int, least: float) -> tuple[int, int]:
    """(bits of a bucket's key, number of tables) for that many vectors.

    Two vectors fall on the same side of a random hyperplane with a probability of
    1 - angle / pi, which gives the tables needed for the allowed miss.
    """
    bits = max(0, math.ceil(math.log2(max(vectors, 1) / BUCKET)))
    if bits == 0:
        return 0, 1
    shared = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log1p(-shared))


_ROTATIONS: dict[tuple[int, int], np.ndarray] = {}


def rotations(size: int, count: int) -> np.ndarray:
    """``count`` random rotations side by side; the first one makes the codes."""
    if (size, count) not in _ROTATIONS:
        draw = np.random.default_rng(SEED)
        parts = []
        for _ in range(count):
            q, r = np.linalg.qr(draw.standard_normal((size, size)))
            parts.append(q * np.sign(np.diag(r)))
        _ROTATIONS[size, count] = np.concatenate(parts, axis=1)
    return _ROTATIONS[size, count]


def bucket_keys(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Each vector's bucket in each table: the signs of ``bits`` rotated components."""
    size = units.shape[1]
    turned = units @ rotations(size, max(1, -(-bits * tables // size)))[:, : bits * tables]
    signs = (turned > 0).reshape(len(units), tables, bits)
    return signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary codes and correction factors.

    The code is the sign of each rotated component. The factor is the inner
    product of a vector with its code's unit vector; dividing by it makes the
    estimate of other inner products unbiased.
    """
    turned = units @ rotations(units.shape[1], 1)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(units.shape[1])


def upper_bounds(codes: np.ndarray, factors: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """How large the inner products of coded vectors with rotated ones may be.

    The lesser of the estimate plus its confidence bound, and of what is certain
    from the angles to the code's vector.
    """
    size = turned.shape[1]
    signs = np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1
    share = np.clip((signs @ turned.astype(np.float32).T) / np.float32(math.sqrt(size)), -1, 1)
    kept = factors.astype(np.float32)[:, None]
    rest = np.sqrt(np.maximum(1 - kept**2, 0))
    confident = share / kept + rest / kept * np.float32(DEVIATIONS / math.sqrt(max(size - 1, 1)))
    certain = kept * share + rest * np.sqrt(1 - share**2)
    return np.minimum(confident, certain)


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _compare(group: pd.DataFrame, least: float, bits: int, tables: int) -> pd.DataFrame:
    """Each member's links to the visitors, and stars that connect what is linked.

    A pair that shares several buckets counts in the first of them only.
    """
    at_table = int(group["table"].iloc[0])
    group = group.sort_values("node")
    chosen = group["member"].to_numpy(dtype=bool)
    members, visitors = group[chosen], group[~chosen]
    nodes = np.unique(group["node"].to_numpy())
    stars = Stars(len(nodes))
    links = np.zeros(len(members), dtype=np.int64)
    if len(members) and len(visitors):
        ours = _units(np.stack(members["vector"].to_numpy()).astype(np.float64))
        theirs = _units(np.stack(visitors["vector"].to_numpy()).astype(np.float64))
        our_keys, their_keys = bucket_keys(ours, bits, tables), bucket_keys(theirs, bits, tables)
        codes = np.stack([np.frombuffer(x, dtype=np.uint8) for x in members["code"]])
        factors = members["factor"].to_numpy()
        turned = theirs @ rotations(theirs.shape[1], 1)
        our_nodes, their_nodes = members["node"].to_numpy(), visitors["node"].to_numpy()
        copies = visitors["copies"].to_numpy()
        for start in range(0, len(members), 128):
            part = slice(start, start + 128)
            may = upper_bounds(codes[part], factors[part], turned) >= least - 1e-5
            m, v = np.nonzero(may)
            m += start
            for low in range(0, len(m), 1 << 16):
                a, b = m[low : low + (1 << 16)], v[low : low + (1 << 16)]
                new = (our_nodes[a] != their_nodes[b]) & ~(our_keys[a, :at_table] == their_keys[b, :at_table]).any(axis=1)
                a, b = a[new], b[new]
                close = (ours[a] * theirs[b]).sum(axis=1) >= least
                a, b = a[close], b[close]
                np.add.at(links, a, copies[b])
                stars.add(np.searchsorted(nodes, our_nodes[a]), np.searchsorted(nodes, their_nodes[b]))
    root = stars.root()
    moved = root != np.arange(len(nodes))
    linked = links > 0
    return pd.DataFrame(
        {
            "node": np.concatenate([members["node"].to_numpy()[linked], nodes[moved]]),
            "links": np.concatenate([links[linked], np.zeros(moved.sum(), dtype=np.int64)]),
            "root": pd.array([None] * int(linked.sum()) + nodes[root[moved]].tolist(), dtype="Int64"),
        }
    )


def near_embeddings(
    vectors: DataFrame, ident: str = "vec_id", embedding: str = "embedding", least: float = LEAST_COSINE
) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector.

    Vectors are linked from a cosine of ``least``, in double precision. Equal
    vectors are compared once, with their number. Distinct ones are filed in
    several tables of buckets; inside a bucket, codes and correction factors bound
    each inner product, and pairs whose bound reaches ``least`` are recomputed
    exactly. Large buckets are compared in pieces, and pairs are never emitted:
    each piece returns numbers of links and stars.

    A null vector, and one that is empty, zero or has null or non-finite
    components, links with nothing and is its own component. So do vectors of
    different sizes with each other. Repeated ids are separate vectors; a null id
    is returned, but is no ``component_id`` while the component has another. No
    rows give no rows.
    """
    value = F.col(embedding)
    fine = F.coalesce(
        (F.size(value) > 0)
        & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(value, lambda x: x != 0),
        F.lit(False),
    )
    rows = written(
        vectors.select(
            F.col(ident).alias("id"),
            F.when(fine, value).alias("vector"),
            F.when(fine, F.xxhash64(value)).alias("k1"),
            F.when(fine, F.xxhash64(F.lit(7), value)).alias("k2"),
        ),
        "vectors",
    )
    distinct = written(
        rows.where("vector IS NOT NULL")
        .groupBy("k1", "k2")
        .agg(F.any_value("vector").alias("vector"), F.count("*").alias("copies"), F.min("id").alias("least_id"))
        .withColumn("node", F.monotonically_increasing_id()),
        "distinct-vectors",
    )
    bits, tables = tables_for(distinct.count(), least)

    def filed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["vector"].map(len)):
                for start in range(0, len(part), 512):
                    piece = part[start : start + 512]
                    units = _units(np.stack(piece["vector"].to_numpy()).astype(np.float64))
                    keys = bucket_keys(units, bits, tables)
                    codes, factors = encode(units)
                    piece = piece.assign(code=[x.tobytes() for x in codes], factor=factors, size=size, home=True)
                    for table in range(tables):
                        yield piece.assign(table=table, bucket=keys[:, table])[
                            ["table", "size", "bucket", "node", "copies", "vector", "code", "factor", "home"]
                        ]

    kind = dict(distinct.dtypes)["vector"]
    shards = distinct.select("node", "copies", "vector").mapInPandas(
        filed,
        f"table int, size int, bucket long, node long, copies long, vector {kind}, code binary, factor double, home boolean",
    )
    keys = ["table", "size", "bucket"]
    found = written(
        in_pieces(shards, keys, "node")
        .groupBy(*keys, "member_piece", "visitor_piece")
        .applyInPandas(lambda group: _compare(group, least, bits, tables), "node long, links long, root long"),
        "vector-links",
    )
    counts = written(found.groupBy("node").agg(F.sum("links").alias("links")), "link-counts")
    joined = connected(found.where("root IS NOT NULL"), "node", "root")
    named = written(
        distinct.select("k1", "k2", "node", "copies", "least_id")
        .join(counts, "node", "left")
        .join(joined, "node", "left")
        .withColumn("root", F.coalesce("root", "node")),
        "rooted-vectors",
    )
    least_ids = written(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "least-ids")
    facts = written(
        named.join(least_ids, "root").select(
            "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
        ),
        "vector-facts",
    )
    linked = rows.where("vector IS NOT NULL").join(facts, ["k1", "k2"]).select("id", "n_links", "component_id")
    alone = rows.where("vector IS NULL").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.union(alone).select(
        F.col("id").alias(ident),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
