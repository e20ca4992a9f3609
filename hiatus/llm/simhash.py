"""SimHash near-duplicates, linked through vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiatus.llm.components import connected
from hiatus.llm.shards import Stars, in_pieces
from hiatus.llm.tables import fresh, levels_for, text_bytes, written

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Members of a leaf on average, levels of a tree at most, and sampled
#: fingerprints for each leaf; together they bound the sample by 65,536.
LEAF, LEVELS, SAMPLE_PER_LEAF = 1024, 12, 16

_LANES = np.zeros(256, dtype=np.uint64)
for _bit in range(8):
    _LANES |= ((np.arange(256, dtype=np.uint64) >> np.uint64(_bit)) & np.uint64(1)) << np.uint64(8 * _bit)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set, from the lowest.

    A table spreads each byte's bits over eight byte-wide lanes, which add up 255
    hashes at a time without overflow.
    """
    counts = np.zeros(64, dtype=np.int64)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for start in range(0, len(hashes), 255 * 256):
        lanes = _LANES[octets[start : start + 255 * 256]]
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, as a signed integer; no words give zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        digest, seed = xxhash.xxh64_intdigest, SEED
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
        hashes = np.fromiter(
            (digest(joined[a:b], seed) for a, b in spans),
            dtype=np.uint64,
            count=len(words) - shingle + 1,
        )
    bits = _bit_counts(hashes) * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprint(documents: DataFrame, name: str, text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(x, shingle) for x in batch], dtype="int64")

    return documents.withColumn(name, of(text_bytes(text)))


def _blocks(max_bits: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of three blocks.

    Fingerprints that differ in at most max_bits bits differ in at most a third
    of that, rounded down, in one block at least.
    """
    return [(0, 22, max_bits // 3), (22, 21, max_bits // 3), (43, 21, max_bits // 3)]


def _block_values(prints: np.ndarray, first: int, bits: int) -> np.ndarray:
    return (prints.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << bits) - 1)


def grow_tree(values: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and median distances of a tree in heap order.

    Each node's vantage point is its first sampled value; values up to the median
    distance go left, the others right.
    """
    points = np.zeros(2**levels - 1, dtype=np.uint64)
    medians = np.zeros(2**levels - 1, dtype=np.int64)
    parts = {0: values}
    for node in range(2**levels - 1):
        part = parts.pop(node)
        if len(part) == 0:
            parts[2 * node + 1] = parts[2 * node + 2] = part
            continue
        points[node] = part[0]
        distance = np.bitwise_count(part ^ part[0]).astype(np.int64)
        median = int(np.median(distance))
        if (distance <= median).all() and median > 0:
            median -= 1
        medians[node] = median
        parts[2 * node + 1] = part[distance <= median]
        parts[2 * node + 2] = part[distance > median]
    return points, medians


def route(values: np.ndarray, tree: tuple[np.ndarray, np.ndarray], radius: int):
    """(row, leaf, home) of every leaf that may hold a value within the radius.

    By the triangle inequality a neighbour's distance from a vantage point is at
    most the radius away from the value's own, so a branch is pruned when the
    median lies further off than that.
    """
    points, medians = tree
    rows = np.arange(len(values))
    nodes = np.zeros(len(values), dtype=np.int64)
    home = np.ones(len(values), dtype=bool)
    for _ in range(int(np.log2(len(points) + 1))):
        distance = np.bitwise_count(values[rows] ^ points[nodes]).astype(np.int64)
        median = medians[nodes]
        left, right = distance - radius <= median, distance + radius > median
        inside = distance <= median
        rows, nodes, home = (
            np.concatenate([rows[left], rows[right]]),
            np.concatenate([2 * nodes[left] + 1, 2 * nodes[right] + 2]),
            np.concatenate([(home & inside)[left], (home & ~inside)[right]]),
        )
    return rows, nodes - len(points), home


def _compare(group: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Links of each visitor and member within the distance, as stars."""
    members = np.unique(group["fingerprint"].to_numpy()[group["member"].to_numpy(dtype=bool)])
    visitors = np.unique(group["fingerprint"].to_numpy()[~group["member"].to_numpy(dtype=bool)])
    prints = np.unique(np.concatenate([members, visitors]))
    member_at, visitor_at = np.searchsorted(prints, members), np.searchsorted(prints, visitors)
    stars = Stars(len(prints))
    for start in range(0, len(members), 128):
        apart = np.bitwise_count(
            members[start : start + 128, None].view(np.uint64) ^ visitors[None, :].view(np.uint64)
        )
        m, v = np.nonzero(apart <= max_bits)
        m, v = member_at[m + start], visitor_at[v]
        stars.add(m[m != v], v[m != v])
    root = stars.root()
    moved = root != np.arange(len(prints))
    return pd.DataFrame({"low": prints[root[moved]], "high": prints[moved]})


def links(prints: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """Links (low, high) that join all fingerprints at most max_bits bits apart.

    ``prints`` has distinct fingerprints. A vantage-point tree for each of three
    blocks of bits is grown from a bounded sample; a fingerprint is a member of
    one leaf and visits every leaf whose bounds its radius overlaps. Pieces of
    members and visitors are compared bit by bit; each returns stars that connect
    what it found, never all pairs.
    """
    spark = prints.sparkSession
    levels = levels_for(prints.count(), leaf, LEVELS)
    sample = np.array(
        [
            row.fingerprint
            for row in prints.orderBy(F.xxhash64("fingerprint"), "fingerprint")
            .limit(SAMPLE_PER_LEAF * 2**levels)
            .collect()
        ],
        dtype=np.int64,
    )
    blocks = _blocks(max_bits)
    trees = spark.sparkContext.broadcast(
        [grow_tree(_block_values(sample, first, bits), levels) for first, bits, _ in blocks]
    )

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fingerprint"].to_numpy()
            for block, (first, bits, radius) in enumerate(blocks):
                rows, leaves, home = route(_block_values(values, first, bits), trees.value[block], radius)
                yield pd.DataFrame(
                    {"block": block, "leaf": leaves, "fingerprint": values[rows], "home": home}
                )

    visits = prints.mapInPandas(routed, "block int, leaf long, fingerprint long, home boolean")
    return (
        in_pieces(visits, ["block", "leaf"], "fingerprint")
        .groupBy("block", "leaf", "member_piece", "visitor_piece")
        .applyInPandas(lambda group: _compare(group, max_bits), "low long, high long")
        .distinct()
    )


def near_duplicates(
    documents: DataFrame,
    text: str = "text",
    ident: str = "doc_id",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every document with its fingerprint, its component and whether it is kept.

    Returns the columns in ``keep`` (all by default) with ``fingerprint`` (16 hex
    digits), ``component_id`` (the smallest id reachable over links) and ``kept``
    (true for one document of each component: the one with the smallest id, ties
    going to an arbitrary one of the rows that share it). Columns of these names
    in the input are replaced. A null or empty text has fingerprint zero and is
    linked like any other. A null id counts as larger than all others, and a
    component of null ids alone has a null ``component_id``. Repeated rows stay
    separate rows of one component. No rows give no rows.
    """
    keep = [c for c in (keep or documents.columns) if c not in ("fingerprint", "component_id", "kept")]
    named = documents.select(*keep, *([] if ident in keep else [ident]), *([] if text in keep else [text]))
    row, code = fresh(named, "_row"), fresh(named, "_code")
    rows = written(
        with_fingerprint(named, code, text, shingle)
        .withColumn(row, F.monotonically_increasing_id())
        .select(*dict.fromkeys([*keep, ident]), row, code),
        "fingerprints",
    )
    order = F.struct(F.col(ident).isNull().alias("absent"), F.col(ident).alias("id"), F.col(row).alias("row"))
    prints = written(
        rows.groupBy(F.col(code).alias("fingerprint")).agg(F.min(order).alias("first")), "prints"
    )
    joined = connected(links(prints.select("fingerprint"), max_bits), "low", "high")
    rooted = written(
        prints.join(joined, F.col("fingerprint") == F.col("node"), "left").select(
            "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
        ),
        "rooted",
    )
    firsts = written(rooted.groupBy("root").agg(F.min("first").alias("least")), "firsts")
    named_prints = written(
        rooted.join(firsts, "root").select(F.col("fingerprint").alias(code), "least"), "components"
    )
    out = rows.join(named_prints, code)
    return out.select(
        *keep,
        F.lower(F.lpad(F.hex(code), 16, "0")).alias("fingerprint"),
        F.col("least.id").alias("component_id"),
        (F.col(row) == F.col("least.row")).alias("kept"),
    )
