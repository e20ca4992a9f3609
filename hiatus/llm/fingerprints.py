"""MinHash fingerprints of documents, of edited documents, and near-duplicates by bands."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiatus.llm.components import connected
from hiatus.llm.shards import in_pieces
from hiatus.llm.tables import text_bytes, written
from hiatus.operators.ordering import totals_before

SHINGLE_WORDS = 5
LEAST_JACCARD = 0.8
SEED = 11
#: Permutations, in bands of four: a pair at 0.8 shares no band once in 20 million.
PERMUTATIONS, BAND = 128, 4
BANDS = PERMUTATIONS // BAND
#: Consecutive documents of about so many bytes are edited in one group.
GROUP_BYTES = 32 << 20
MOST_GROUPS = 50_000
#: Bytes that a row takes beside its text.
_ROW_BYTES = 64
#: Pairs whose signatures agree in a share this far below the threshold (more than
#: four standard deviations) are not verified.
SLACK = 0.16
#: Texts on either side of a piece of a band's bucket.
PIECE = 512

_BLOCK = 256
_BASE = np.uint64(0x9E3779B97F4A7C15)


class MinHash:
    """Signatures under ``PERMUTATIONS`` strongly universal hash functions.

    Each maps 32-bit shingle keys by (a * key + b) mod 2**64, of which the upper half
    is the hash. Of the least hash its lower 16 bits are kept (b-bit MinHash), so
    that unequal sets agree in a place by accident once in 65,536 times.
    """

    def __init__(self, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.a = random.integers(0, 1 << 64, (PERMUTATIONS, 1), dtype=np.uint64)
        self.b = random.integers(0, 1 << 64, (PERMUTATIONS, 1), dtype=np.uint64)
        self.room = np.empty((PERMUTATIONS, _BLOCK), dtype=np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """128 values of 16 bits; no shingles give the highest value everywhere."""
        least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
        keys = shingles >> np.uint64(32)
        for start in range(0, len(keys), _BLOCK):
            some = keys[start : start + _BLOCK]
            room = self.room[:, : len(some)]
            np.multiply(self.a, some, out=room)
            np.add(room, self.b, out=room)
            np.minimum(least, room.min(axis=1), out=least)
        return ((least >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.uint16)


def shingles(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit hashes of the runs of ``size`` words, repeats included.

    Words are split at ASCII white space, A-Z in lower case. Fewer words, but not
    none, are one shingle.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    hashed = np.array([digest(word) for word in words], dtype=np.uint64)
    size = min(size, len(words))
    mixed = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for place in range(size):
        mixed = mixed * _BASE + hashed[place : len(words) - size + 1 + place]
    mixed ^= mixed >> np.uint64(33)
    mixed *= np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(29)
    return mixed


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """The share of equal places, which estimates the Jaccard similarity."""
    return float(np.count_nonzero(one == other)) / PERMUTATIONS


def shares_band(one: np.ndarray, other: np.ndarray) -> bool:
    return bool((one.reshape(BANDS, BAND) == other.reshape(BANDS, BAND)).all(axis=1).any())


def jaccard(one: np.ndarray, other: np.ndarray) -> float:
    """Of two sorted sets; two empty ones are equal."""
    if not len(one) and not len(other):
        return 1.0
    common = len(np.intersect1d(one, other, assume_unique=True))
    return common / (len(one) + len(other) - common)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class _Signed:
    """A text with its shingles and signature."""

    def __init__(self, text: bytes, hashes: MinHash):
        self.text = text
        self.shingles = shingles(text)
        self.signature = hashes.signature(self.shingles)
        self._set = None

    def verified(self, other: _Signed) -> float | None:
        """The Jaccard similarity, for candidates alone: texts that share a band."""
        if not shares_band(self.signature, other.signature):
            return None
        return jaccard(self.distinct(), other.distinct())

    def distinct(self) -> np.ndarray:
        if self._set is None:
            self._set = np.unique(self.shingles)
        return self._set


_RESULT = T.StructType(
    [
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("jaccard_edited", T.DoubleType()),
        T.StructField("jaccard_next", T.DoubleType()),
    ]
)


def _facts(one: _Signed, following: _Signed, hashes: MinHash) -> tuple:
    text = one.text.decode("utf-8", "surrogateescape")
    changed = edited(text, following.text.decode("utf-8", "surrogateescape")).encode("utf-8", "surrogateescape")
    other = one if changed == one.text else _Signed(changed, hashes)
    return (
        len(text),
        hashlib.sha256(changed).hexdigest(),
        one.signature.tobytes().hex(),
        other.signature.tobytes().hex(),
        likeness(one.signature, other.signature),
        likeness(one.signature, following.signature),
        one.verified(other),
        one.verified(following),
    )


def _key(ident, digest: bytes) -> tuple:
    """Sorts like the ids in Spark, nulls first, then like the digests."""
    return (0, digest) if ident is None else (1, ident, digest)


@dataclass(frozen=True)
class _Order:
    """Where the groups begin in the order of (id, digest), and which pairs cross their borders.

    All three lists grow with the number of groups alone.
    """

    starts: list  # the first pair of each group
    parts: dict  # pairs that repeat beyond a group's size: the parts they are dealt over
    lent: dict  # pairs that the pair before needs in its own group: (group, parts, whether it is the last pair)

    def deal(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with their group and part, and lent rows once a task."""
        turn, done = 0, set()
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            rows, source = [], []
            for place, (ident, text) in enumerate(zip(ids, texts)):
                digest = hashlib.md5(text).digest()
                key = _key(ident, digest)
                turn += 1
                rows.append((bisect_right(self.starts, key) - 1, turn % self.parts.get(key, 1), 0, True, digest))
                source.append(place)
                if key in self.lent and key not in done:
                    done.add(key)
                    group, parts, last = self.lent[key]
                    rows += [(group, part, int(last), False, digest) for part in range(parts)]
                    source += [place] * parts
            for some in range(0, len(rows), 1024):
                taken = batch.take(pa.array(source[some : some + 1024], pa.int64()))
                columns = zip(*rows[some : some + 1024])
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(columns, kinds)] + [taken.column("id"), taken.column("text")],
                    names=["bucket", "salt", "late", "own", "digest", "id", "text"],
                )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts of each own row, once the pair that follows in its group has come.

    One text is held at a time, with the ids of its copies.
    """
    hashes = MinHash()
    group = seat = held = None
    waiting: list = []
    kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}

    for batch in batches:
        ids, out = [], []
        columns = [batch.column(c).to_pylist() for c in ("bucket", "salt", "late", "digest", "own", "id", "text")]
        for bucket, salt, late, digest, own, ident, text in zip(*columns):
            if (bucket, salt) != group:
                group, seat, held, waiting = (bucket, salt), None, None, []
            place = (late, ident, digest)
            if place != seat:
                signed = held if held is not None and held.text == text else _Signed(text, hashes)
                if waiting:
                    ids += waiting
                    out += [_facts(held, signed, hashes)] * len(waiting)
                seat, held, waiting = place, signed, []
            if own:
                waiting.append(ident)
        columns = list(zip(*out)) or [()] * len(_RESULT)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.schema.field("id").type)]
            + [pa.array(values, kinds[f.dataType.simpleString()]) for values, f in zip(columns, _RESULT)],
            names=["id", *_RESULT.names],
        )


def _order(texts: DataFrame, group_bytes: int) -> _Order:
    """Divides the distinct (id, text) pairs, in the order of ids, into groups of so many bytes.

    There are ``MOST_GROUPS`` groups at most; beyond that they grow. A pair that repeats
    beyond a group's size is dealt over parts, of which there are no more than groups.
    """
    weight = F.col("n") * (F.col("n_bytes") + _ROW_BYTES)
    pairs = written(
        texts.groupBy("id", F.unhex(F.md5("text")).alias("digest"))
        .agg(F.count("*").alias("n"), F.max(F.octet_length("text")).cast("long").alias("n_bytes"))
        .withColumn("weight", weight),
        "pairs",
    )
    count, total = pairs.agg(F.count("*"), F.sum("weight")).first()
    size = max(group_bytes, (total or 0) // MOST_GROUPS + 1)
    placed = written(
        totals_before(
            pairs,
            [F.asc_nulls_first("id"), F.asc("digest")],
            {"rank": F.lit(1).cast("long"), "before": F.col("weight")},
            store=lambda frame: written(frame, "ordered-ids"),
        ).select(
            "id",
            "digest",
            "rank",
            F.floor(F.col("before") / size).alias("bucket"),
            F.when(F.col("n") > 1, F.ceil(F.col("weight") / size)).otherwise(1).cast("long").alias("parts"),
        ),
        "places",
    )
    first = placed.groupBy("bucket").agg(F.min_by(F.struct("id", "digest"), "rank").alias("pair"))
    starts = sorted(_key(r.pair.id, bytes(r.pair.digest)) for r in first.collect())
    earlier = placed.select(
        F.pmod(F.col("rank") + 1, F.lit(max(count, 1))).alias("rank"),
        F.struct("id", "digest").alias("before"),
        F.col("bucket").alias("before_bucket"),
        F.col("parts").alias("before_parts"),
    )
    crossing = placed.join(earlier, "rank").where(
        "rank = 0 OR bucket <> before_bucket OR parts > 1 OR before_parts > 1"
    )
    lent, parts = {}, {}
    for r in crossing.collect():
        key, before = _key(r.id, bytes(r.digest)), _key(r.before.id, bytes(r.before.digest))
        group = bisect_right(starts, before) - 1
        lent[key] = (group, r.before_parts, r.rank == 0)
        if r.parts > 1:
            parts[key] = r.parts
    return _Order(starts, parts, lent)


def edited_fingerprints(
    documents: DataFrame, ident: str = "doc_id", text: str = "text", group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """Fingerprints of every text and of its edited form, which runs into the next text.

    The last half of a text's code points, rounded down, is replaced by the first as
    many of the next document's; documents are ordered by id, nulls first, then by
    the MD5 of the text, and the first follows the last. Returns the id (under its
    name), ``n_chars``, ``edited_sha256``, ``fingerprint`` and ``edited_fingerprint`` (128 values
    of 16 bits, in hex), ``near_edited`` and ``near_next`` (the shares of equal values),
    and ``jaccard_edited`` and ``jaccard_next``: the similarity on five-word shingles,
    verified where a band of the signatures agrees, else null.

    Ids are integers, texts, binary or dates. Equal texts have equal fingerprints. A null
    text is empty; empty texts are alike. Rows that repeat both id and text count as
    one in the order, and all get its facts. Bytes that are no UTF-8 count as a
    code point each. No rows give no rows; other columns are not carried.

    Ids, digests and lengths alone are ordered first. Texts then go through one
    shuffle, in groups of consecutive ids which are sorted and read one text
    at a time, so memory is bounded by a text. The first text of each group is lent
    to the one before. What the driver and the tasks hold of the order is three
    pairs for each of ``MOST_GROUPS`` groups at most.
    """
    texts = documents.select(F.col(ident).alias("id"), text_bytes(text).alias("text"))
    order = _order(texts, group_bytes)
    id_field = T.StructField("id", texts.schema["id"].dataType)
    dealt = T.StructType.fromDDL("bucket long, salt long, late int, own boolean, digest binary")
    rows = texts.mapInArrow(order.deal, T.StructType([*dealt.fields, id_field, T.StructField("text", T.BinaryType())]))
    groups = rows.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "late", "id", "digest")
    return groups.mapInArrow(_walk, T.StructType([id_field, *_RESULT.fields])).withColumnRenamed("id", ident)


# Near-duplicates


def _signed(texts: DataFrame) -> DataFrame:
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = MinHash()
        for batch in batches:
            signatures = [hashes.signature(shingles(text)) for text in batch.pop("text")]
            yield batch.assign(signature=[s.tobytes() for s in signatures], bands=[s.view("<i8") for s in signatures])

    return texts.mapInPandas(sign, "digest string, signature binary, bands array<long>")


def _linked(piece: pd.DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of a member and a visitor, without those already connected by others."""
    member = piece["member"].to_numpy(dtype=bool)
    members, visitors = np.flatnonzero(member), np.flatnonzero(~member)
    signatures = np.stack([np.frombuffer(s, dtype=np.uint16) for s in piece["signature"]])
    sets = [np.asarray(s, dtype=np.int64) for s in piece["shingles"]]
    same = {d: i for i, d in zip(members[::-1], piece["digest"].iloc[members[::-1]])}
    root = [same.get(d, i) for i, d in enumerate(piece["digest"])]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    left, right = [], []
    for i in members:
        agree = np.count_nonzero(signatures[visitors] == signatures[i], axis=1) / PERMUTATIONS
        for j in visitors[agree >= least - SLACK]:
            if find(i) != find(j) and jaccard(sets[i], sets[j]) >= least:
                root[find(i)] = find(j)
                left.append(i)
                right.append(j)
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def near_duplicates(
    documents: DataFrame, ident: str = "doc_id", text: str = "text", least: float = LEAST_JACCARD
) -> DataFrame:
    """(id, class_id): the smallest id reachable over pairs of Jaccard ``least`` or more.

    Equal texts are one class. The signatures of distinct texts are joined on their
    bands; a bucket with many texts is compared in a grid of pieces, and the pairs
    of a piece whose signatures come near the threshold are verified on their
    shingle sets unless other verified pairs already connect them. Texts without
    words are alike. A null text is empty. Null ids get the class of their text.
    No rows give no rows. Other columns are not carried.
    """
    texts = documents.select(F.col(ident).alias("id"), text_bytes(text).alias("text")).withColumn(
        "digest", F.md5("text")
    )
    distinct = texts.groupBy("digest").agg(F.any_value("text").alias("text"))
    signed = written(_signed(distinct.select("digest", "text")), "signatures")
    buckets = signed.select("digest", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    candidates = written(buckets.join(shared, ["band", "key"], "left_semi"), "band-buckets")

    @F.pandas_udf("array<long>")
    def distinct_shingles(batch: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingles(t)).view(np.int64) for t in batch])

    sets = written(
        distinct.join(candidates.select("digest").distinct(), "digest", "left_semi")
        .select("digest", distinct_shingles("text").alias("shingles"))
        .join(signed.select("digest", "signature"), "digest"),
        "shingle-sets",
    )
    routed = candidates.join(sets, "digest").withColumn("home", F.lit(True))

    def compare(piece: pd.DataFrame) -> pd.DataFrame:
        left, right = _linked(piece, least)
        digests = piece["digest"].to_numpy()
        return pd.DataFrame({"one": digests[left], "other": digests[right]})

    keys = ["band", "key"]
    pieces = in_pieces(routed, keys, "digest", PIECE).groupBy(*keys, "member_piece", "visitor_piece")
    links = pieces.applyInPandas(compare, "one string, other string")
    roots = connected(written(links.distinct(), "minhash-links"), "one", "other")
    classed = texts.select("id", "digest").join(
        roots.select(F.col("node").alias("digest"), "root"), "digest", "left"
    ).select("id", F.coalesce("root", "digest").alias("class"))
    least_id = classed.groupBy("class").agg(F.min("id").alias("class_id"))
    return classed.join(least_id, "class").select(F.col("id").alias(ident), "class_id")
