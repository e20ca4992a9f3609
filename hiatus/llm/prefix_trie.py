"""The trie of conversations' first turns, built in shards of sorted turn-id matrices."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiatus.llm.tables import written

#: Columns of a matrix; longer conversations go on in further matrices without the shorter.
WIDTH = 16
_ID = 32  # characters of a turn's MD5 in a sequence's key
_NONE = hashlib.sha256(b"").hexdigest()

_TURNS = "array<struct<id:string,n_bytes:bigint>>"


def turn_sequences(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, turns): a row for each conversation with its turns' ids and text bytes in order.

    A turn's id is the MD5 of role and text, null as empty. Turns are ordered by ``turn``,
    nulls first, ties by id. Conversations are whole numbers; rows whose number is null
    belong to none and are left out. A turn takes about 50 bytes here whatever its
    text, and a conversation's turns are one value.
    """
    said = F.coalesce(F.col(text).cast("binary"), F.lit(b"").cast("binary"))
    who = F.coalesce(F.col(role).cast("binary"), F.lit(b"").cast("binary"))
    named = F.md5(F.concat(F.octet_length(who).cast("string").cast("binary"), F.lit(b":").cast("binary"), who, said))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).cast("long").alias("turn"), named.alias("id"), F.octet_length(said).cast("long").alias("n_bytes")
        ).alias("said"),
    )
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    return listed.select(
        "conv_id", F.transform("said", lambda t: F.struct(t.id.alias("id"), t.n_bytes.alias("n_bytes"))).alias("turns")
    )


def spliced(sequences: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Conversations that begin with turns of the first of their family.

    Conversation c takes the first h turns of c - c % ``family`` (all if there are fewer, none
    if there is no such conversation), then its own after its first h; h is the CRC-32 of
    c's digits modulo ``most``. The remainder has the sign of c, as in SQL.
    """
    first = F.col("conv_id") - F.col("conv_id") % family
    heads = sequences.select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, most - 1).alias("head"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    joined = sequences.withColumn("head_id", first).withColumn("h", taken).join(heads, "head_id", "left")
    nothing = F.array().cast(_TURNS)
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.slice(F.coalesce("head", nothing), F.lit(1), F.col("h"))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


class _Shard:
    """All nodes of the conversations of one range of the sorted sequences."""

    def __init__(self, convs: np.ndarray, keys: list[str], sizes: np.ndarray):
        self.convs = convs
        self.lengths = np.fromiter((len(k) // _ID for k in keys), dtype=np.int64, count=len(keys))
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.names = np.frombuffer("".join(keys).encode(), dtype=f"S{_ID}")
        self.turns = np.unique(self.names, return_inverse=True)[1].astype(np.int64) + 1
        self.sizes = sizes
        # The root.
        self.depth = [np.zeros(1, dtype=np.int64)]
        self.conv = [convs.min(keepdims=True)]
        self.count = [np.array([len(convs)])]
        self.bytes = [np.zeros(1, dtype=np.int64)]
        self.parent = [np.array([-1])]
        self.node = np.zeros(len(convs), dtype=np.int64)  # the deepest node of each row so far
        self.total = 1
        for start in range(0, int(self.lengths.max()), WIDTH):
            self._matrix(start)
        self.depth, self.conv, self.count, self.bytes, self.parent = (
            np.concatenate(x) for x in (self.depth, self.conv, self.count, self.bytes, self.parent)
        )

    def _matrix(self, start: int) -> None:
        """Adds the nodes of ``WIDTH`` depths from ``start`` on."""
        active = np.flatnonzero(self.lengths > start)
        width = int(min(WIDTH, self.lengths[active].max() - start))
        matrix = np.zeros((len(active), width), dtype=np.int64)
        for j in range(width):
            filled = np.flatnonzero(self.lengths[active] > start + j)
            matrix[filled, j] = self.turns[self.offsets[active[filled]] + start + j]
        columns = [matrix[:, j] for j in reversed(range(width))]
        order = np.lexsort((self.convs[active], *columns, self.node[active]))
        rows, matrix = active[order], matrix[order]
        current, convs = self.node[rows], self.convs[rows]

        # A row starts a node at every depth from the first column on in which it changes.
        change = np.ones(matrix.shape, dtype=bool)
        change[1:] = matrix[1:] != matrix[:-1]
        change[1:, 0] |= current[1:] != current[:-1]
        np.logical_or.accumulate(change, axis=1, out=change)

        for j in range(width):
            starts = np.flatnonzero(change[:, j])
            alive = matrix[starts, j] > 0
            heads = starts[alive]
            ids = np.full(len(starts), -1)
            ids[alive] = self.total + np.arange(len(heads))
            self.total += len(heads)
            self.depth.append(np.full(len(heads), start + j + 1))
            self.conv.append(np.minimum.reduceat(convs, starts)[alive])
            self.count.append(np.diff(np.append(starts, len(rows)))[alive])
            self.bytes.append(self.sizes[self.offsets[rows[heads]] + start + j])
            self.parent.append(current[heads])
            of_row = ids[np.cumsum(change[:, j]) - 1]
            current = np.where(of_row >= 0, of_row, current)
        self.node[rows] = current

    def path(self, row: int) -> list[int]:
        """The nodes from the root to the row's end."""
        nodes, node = [], int(self.node[row])
        while node >= 0:
            nodes.append(node)
            node = int(self.parent[node])
        return nodes[::-1]

    def sums(self, own: np.ndarray) -> np.ndarray:
        """Each node's own value and those of all below it; nodes are numbered by depth."""
        total = own.copy()
        edges = np.flatnonzero(np.diff(self.depth)) + 1
        for low, high in reversed(list(zip(edges, [*edges[1:], self.total]))):
            np.add.at(total, self.parent[low:high], total[low:high])
        return total

    def ends(self) -> dict[int, np.ndarray]:
        """The conversations that end at a node, ascending."""
        order = np.lexsort((self.convs, self.node))
        nodes, starts = np.unique(self.node[order], return_index=True)
        return dict(zip(nodes.tolist(), np.split(self.convs[order], starts[1:])))

    def batch(self) -> pa.RecordBatch:
        """Finished nodes, and what this shard knows of those it may share.

        Only nodes on the paths to the first and the last row can have members in other
        shards. They carry a key of their sequence; their leaves and savings leave out the
        shared nodes, and their children too.
        """
        shared: dict[int, str] = {}
        for row in (0, len(self.convs) - 1):
            key = ""
            for depth, node in enumerate(self.path(row)):
                if depth:
                    key = hashlib.md5(key.encode() + self.names[self.offsets[row] + depth - 1]).hexdigest()
                shared[node] = key
        border = np.zeros(self.total, dtype=bool)
        border[list(shared)] = True
        children = np.bincount(self.parent[1:], minlength=self.total)
        leaves = self.sums(np.where(border, 0, children == 0).astype(np.int64))
        saved = self.sums(np.where(border, 0, (self.count - 1) * self.bytes))
        inner = np.bincount(self.parent[1:][~border[1:]], minlength=self.total)
        keys = [shared.get(n) for n in range(self.total)]
        parent_keys = [shared.get(n) for n in self.parent.tolist()]
        parents = [None if p < 0 or k is not None else int(self.conv[p]) for p, k in zip(self.parent, parent_keys)]
        hashes, listed, first = [None if b else _NONE for b in border], [None] * self.total, [None] * self.total
        for node, convs in self.ends().items():
            joined = ",".join(map(str, convs.tolist()))
            if border[node]:
                listed[node], first[node] = joined, int(convs[0])
            else:
                hashes[node] = hashlib.sha256(joined.encode()).hexdigest()
        columns = {
            "key": pa.array(keys, pa.string()),
            "parent_key": pa.array(parent_keys, pa.string()),
            "conv_id": pa.array(self.conv),
            "depth": pa.array(self.depth),
            "parent_conv_id": pa.array(parents, pa.int64()),
            "n_convs": pa.array(self.count),
            "n_children": pa.array(np.where(border, inner, children)),
            "n_leaves": pa.array(leaves),
            "saved_tokens": pa.array(saved),
            "n_bytes": pa.array(self.bytes),
            "ends_sha256": pa.array(hashes, pa.string()),
            "ends": pa.array(listed, pa.string()),
            "first_end": pa.array(first, pa.int64()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


_SHARD = (
    "key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, n_bytes long, ends_sha256 string, ends string, first_end long"
)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    convs, keys, sizes = [], [], [np.zeros(0, dtype=np.int64)]
    for batch in batches:
        convs.append(batch.column("conv_id").to_numpy(zero_copy_only=False))
        keys += batch.column("key").to_pylist()
        sizes.append(batch.column("sizes").flatten().to_numpy(zero_copy_only=False))
    if keys:
        whole = _Shard(np.concatenate(convs), keys, np.concatenate(sizes)).batch()
        for start in range(0, whole.num_rows, 1 << 14):
            yield whole.slice(start, 1 << 14)


def _recombined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds up the shared nodes, level by level from the deepest."""
    parts = [batch for batch in batches if len(batch)]
    if not parts:
        return
    nodes = pd.concat(parts, ignore_index=True).sort_values("depth", kind="stable", ignore_index=True)
    place = pd.Series(nodes.index, index=nodes["key"])
    parent = nodes["parent_key"].map(place).fillna(-1).to_numpy(dtype=np.int64)
    has = parent >= 0
    nodes["n_children"] += np.bincount(parent[has], minlength=len(nodes))
    own = {
        "n_leaves": (nodes["n_children"] == 0).to_numpy(dtype=np.int64),
        "saved_tokens": ((nodes["n_convs"] - 1) * nodes["n_bytes"]).to_numpy(dtype=np.int64),
    }
    depth = nodes["depth"].to_numpy()
    for name, total in own.items():
        for level in range(int(depth.max()), 0, -1):
            low, high = np.searchsorted(depth, [level, level + 1])
            np.add.at(total, parent[low:high], total[low:high])
        nodes[name] += total
    conv = nodes["conv_id"].to_numpy()
    nodes["parent_conv_id"] = pd.array(np.where(has, conv[parent], 0), dtype="Int64")
    nodes.loc[~has, "parent_conv_id"] = pd.NA
    yield nodes[["key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each key's ids, whose runs come in order, one from each shard."""
    key = digest = None
    for batch in batches:
        done = []
        for name, run in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if name != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = name, hashlib.sha256(run.encode())
            else:
                digest.update(b"," + run.encode())
        yield _pairs(done)
    if key is not None:
        yield _pairs([(key, digest.hexdigest())])


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    keys, hashes = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(hashes, pa.string())], names=["key", "ends_sha256"])


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv_id, turns): one for each distinct beginning of conversations.

    Returns ``conv_id`` (the least member), ``depth`` (turns, 0 for the root that all begin with),
    ``parent_conv_id``, ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes in the
    subtree, its top included), ``saved_tokens`` (the subtree's sum of (members - 1) times the
    bytes of a node's last text: what need not be stored again) and ``ends_sha256`` (of the
    ascending, comma-joined members without a further turn).

    Conversations without turns are members of the root. No conversations give no
    nodes. Sequences are sorted over ranges of themselves and then of their id, so even copies
    of one conversation are spread. Each range is a shard. Nodes on the paths to its
    first and last row may go on in other shards: those, two paths a shard, are added up in
    one task, and the ids that end at them, joined in each shard, are hashed in order.
    """
    ranged = (
        sequences.select(
            "conv_id",
            F.array_join(F.transform("turns", lambda t: t.id), "").alias("key"),
            F.transform("turns", lambda t: t.n_bytes).alias("sizes"),
        )
        .repartitionByRange("key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
    )
    nodes = written(ranged.mapInArrow(_nodes, _SHARD), "trie-nodes")
    border = nodes.where("key IS NOT NULL")
    merged = border.groupBy("key").agg(
        F.any_value("parent_key").alias("parent_key"),
        F.any_value("depth").alias("depth"),
        F.any_value("n_bytes").alias("n_bytes"),
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    schema = "key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    joined = written(merged.coalesce(1).mapInPandas(_recombined, schema), "shared-nodes")
    # Equal sequences are sorted by id, so the runs of ids that shards hold of them don't overlap.
    runs = border.where("ends IS NOT NULL").select("key", "first_end", "ends")
    ends = runs.repartition("key").sortWithinPartitions("key", "first_end").mapInArrow(_hashed, "key string, ends_sha256 string")

    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    finished = nodes.where("key IS NULL")
    below = finished.where("parent_key IS NOT NULL").drop("parent_conv_id").join(
        joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")), "parent_key"
    )
    shared = joined.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NONE)))
    return (
        finished.where("parent_key IS NULL").select(*columns).unionByName(below.select(*columns)).unionByName(shared.select(*columns))
    )
