"""Finding benchmark passages in documents by a prefix-filtered set join.

A window of the benchmark is the set of its shingles (three consecutive words, or the
whole window if it is shorter), ordered by how rarely the documents hold them. A
document that contains the window holds all of them, so the prefix that has to be
joined is the rarest shingle alone. The join is Spark's, on that shingle; length and
position bounds and a comparison of the words around it follow.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiatus.llm.tables import discard, fresh, text_bytes, written

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
#: A filter has 16 bits for each of its values, and at most these many (32 MB). With
#: more values it lets more rows pass to the join, which decides.
FILTER_BITS = 1 << 28
_SEGMENT_BITS = 18  # a filter is put together in segments of 32 KB
_ROWS = 20_000  # rows of a batch sent back by a task
_BLOCK_BYTES = 1 << 19  # texts are hashed together, and long ones cut, at about this size
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    """Lower-cased words of ASCII letters, digits and all bytes beyond ASCII."""
    return text.translate(_WORD_BYTES).split()


_IN_WORD = np.frombuffer(_WORD_BYTES, np.uint8) != 0x20


@F.pandas_udf(T.LongType())
def word_count(contents: pd.Series) -> pd.Series:
    """How many words :func:`words` finds: bytes of a word that follow none."""
    counts = []
    for content in contents:
        inside = _IN_WORD[np.frombuffer(content, np.uint8)]
        counts.append(np.count_nonzero(inside[1:] > inside[:-1]) + int(inside[:1].sum()))
    return pd.Series(counts, dtype="int64")


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def word_hashes(cleaned: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a translated text begin, and a 64-bit hash of each.

    A word's hash is a polynomial in its bytes, taken from sums up to its ends. Texts
    are cut into blocks between words.
    """
    begins, hashes, first = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
    while first < len(cleaned):
        last = cleaned.find(b" ", first + _BLOCK_BYTES)
        block = np.frombuffer(cleaned[first : last if last >= 0 else len(cleaned)], np.uint8)
        edges = np.flatnonzero(np.diff(block != 0x20, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        size = 1 << max(20, len(block).bit_length())
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(block * _powers(_BASE, size)[: len(block)])))
        begins.append(starts + first)
        hashes.append((sums[ends] - sums[starts]) * _powers(_INVERSE, size)[starts])
        first += len(block)
    return np.concatenate(begins), np.concatenate(hashes)


def shingle_hashes(hashed: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of ``length`` words; runs of other lengths hash apart."""
    count = max(0, len(hashed) - length + 1)
    total = np.full(count, length, np.uint64)
    for i in range(length):
        total = (total ^ hashed[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total.view(np.int64)


class Filter:
    """A Bloom filter over 64-bit hashes with two bits for each."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.mask = np.uint64(len(bits) * 8 - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        values = hashes.view(np.uint64)
        found = np.ones(len(values), bool)
        for place in (values & self.mask, (values >> np.uint64(32)) & self.mask):
            found &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def filter_of(values: DataFrame, most: int = FILTER_BITS) -> Filter:
    """The filter of a column of longs, put together in segments by tasks.

    Its size is a power of two of at most ``most`` bits; segments hold distinct
    bits, so neither a task nor the driver gets more than that.
    """
    (name,) = values.columns
    wanted = 16 * (values.agg(F.approx_count_distinct(name)).first()[0] or 0)
    size = min(most, 1 << max(6, wanted.bit_length()))
    mask = F.lit(size - 1).cast("long")
    places = values.select(
        F.explode(F.array(F.col(name).bitwiseAND(mask), F.shiftrightunsigned(name, 32).bitwiseAND(mask))).alias("place")
    ).distinct()
    held = min(size, 1 << _SEGMENT_BITS)

    def segment(key: tuple[int, ...], rows: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(held, np.uint8)
        flags[(rows["place"].to_numpy() % held)] = 1
        return pd.DataFrame({"segment": [key[0]], "bits": [np.packbits(flags, bitorder="little").tobytes()]})

    parts = places.groupBy(F.floor(F.col("place") / held).cast("long").alias("segment")).applyInPandas(
        segment, "segment long, bits binary"
    )
    bits = np.zeros(size // 8, np.uint8)
    for row in parts.collect():
        bits[row.segment * held // 8 : (row.segment + 1) * held // 8] = np.frombuffer(row.bits, np.uint8)
    return Filter(bits)


def benchmark_windows(benchmark: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """Every window of every item: its words (one space around each), its shingles' hashes
    and the bytes before each shingle. An item of fewer words, but not none, is one window.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for batch in batches:
            for name, content in zip(batch["item"], batch["text"], strict=True):
                found = words(content)
                if not found:
                    continue
                held = min(size, len(found))
                length = min(SHINGLE_WORDS, held)
                shingles = shingle_hashes(word_hashes(content.translate(_WORD_BYTES))[1], length)
                before = np.concatenate(([0], np.cumsum([len(word) + 1 for word in found])))
                for i in range(len(found) - held + 1):
                    last = i + held - length + 1
                    window = b" " + b" ".join(found[i : i + held]) + b" "
                    rows.append((name, window, held, shingles[i:last], before[i:last] - before[i]))
                    if len(rows) == _ROWS:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    columns = ["item", "window", "n_window", "shingles", "before"]
    named = F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item")
    return (
        benchmark.select(named, text_bytes(text).alias("text"))
        .mapInPandas(cut, "item string, window binary, n_window int, shingles array<long>, before array<int>")
        .withColumn("window_id", F.unhex(F.md5("window")))
    )


class Piece:
    """Some texts one after another, and where their shingles pass a filter."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        starts, self.hashed = word_hashes(b" ".join([text.translate(_WORD_BYTES) for text in texts]))
        self.ends = np.searchsorted(starts, np.cumsum([len(text) + 1 for text in texts]))

    def passing(self, length: int, known: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text numbers, places in these texts and hashes of shingles that lie in one text."""
        shingles = shingle_hashes(self.hashed, length)
        places = np.flatnonzero(known.has(shingles))
        text = np.searchsorted(self.ends, places, "right")
        within = places + length <= self.ends[text] if len(places) else places == 0
        places, text = places[within], text[within]
        first = np.concatenate(([0], self.ends))[text]
        return text, places - first, shingles[places]


def pieces(contents: pd.Series) -> Iterator[tuple[int, Piece]]:
    """A batch's texts in pieces, each with the number of its first text."""
    held, size, first = [], 0, 0
    for number, content in enumerate(contents):
        held.append(content)
        size += len(content)
        if size >= _BLOCK_BYTES:
            yield first, Piece(held)
            held, size, first = [], 0, number + 1
    if held:
        yield first, Piece(held)


def shingle_counts(documents: DataFrame, text: str, lengths: list[int], known) -> DataFrame:
    """How often the documents hold each shingle that passes a filter."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            passed = [np.empty(0, np.int64)]
            for _, piece in pieces(batch["text"]):
                passed += [piece.passing(length, known.value)[2] for length in lengths]
            found, n = np.unique(np.concatenate(passed), return_counts=True)
            yield pd.DataFrame({"shingle": found, "n": n})

    return (
        documents.select(text_bytes(text).alias("text"))
        .mapInPandas(count, "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
    )


def places_in_documents(
    documents: DataFrame, text: str, lengths: list[int], known, size: int, longest: int
) -> DataFrame:
    """Where texts hold a shingle that passes a filter, with the words before and from there.

    Texts are named by their digest, so that copies of a text are joined once. The
    words around a place are cut at the bytes of the longest window.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for batch in batches:
            digests = batch["digest"].tolist()
            for first, piece in pieces(batch["text"]):
                for length in lengths:
                    passing = piece.passing(length, known.value)
                    found, of = [], -1
                    for number, place, shingle in zip(*[part.tolist() for part in passing], strict=True):
                        if number != of:
                            found, of = words(piece.texts[number]), number
                        left = b"".join([b" " + word for word in found[max(0, place - size + length) : place]])
                        right = b" " + b" ".join(found[place : place + size]) + b" "
                        rows.append(
                            (digests[first + number], shingle, place, len(found), left[-longest:], right[:longest])
                        )
                        if len(rows) == _ROWS:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    columns = ["digest", "shingle", "place", "n_words", "left", "right"]
    return (
        documents.select(_digest(text).alias("digest"), text_bytes(text).alias("text"))
        .mapInPandas(find, "digest binary, shingle long, place int, n_words int, left binary, right binary")
        .distinct()
    )


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(text_bytes(text), 256))


def _rarest(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows under their rarest shingle; one that no document holds rules its window out."""
    each = windows.select("window_id", F.posexplode("shingles").alias("at", "shingle"))
    chosen = (
        each.join(counts, "shingle", "left")
        .groupBy("window_id")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "at")).alias("rarest"))
        .where("rarest.n > 0")
        .select("window_id", "rarest.shingle", "rarest.at")
    )
    ahead = F.get("before", F.col("at"))
    return windows.join(chosen, "window_id").select(
        "window_id",
        "shingle",
        "at",
        "n_window",
        F.substring("window", F.lit(1), ahead).alias("window_left"),
        F.substring("window", ahead + 1, F.octet_length("window")).alias("window_right"),
    )


def _found(places: DataFrame, chosen: DataFrame) -> DataFrame:
    """Windows that texts contain whole: room on both sides, then equal words."""
    start = F.col("place") - F.col("at")
    return (
        places.join(chosen, "shingle")
        .where((start >= 0) & (start + F.col("n_window") <= F.col("n_words")))
        .where(F.endswith("left", F.col("window_left")) & F.startswith("right", F.col("window_right")))
        .select("digest", "window_id", F.struct(start.alias("start"), (start + F.col("n_window")).alias("end")).alias("span"))
    )


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW_WORDS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Every document with what it shares with the benchmark.

    Adds ``n_words``, ``spans`` (word ranges (start, end) of the windows found),
    ``items`` (ids of the items they come from, as strings, sorted) and replaces
    columns of these names. Null and empty texts have no words. Items without words
    match nothing; an item without an id is listed as the empty string; repeated
    ids are listed once. Repeated rows each get their result. An empty benchmark
    finds nothing; no documents give no rows. Very long texts and items are read by
    one task each, which sends back their places and windows in batches.

    Three reads of the documents: shingles are counted, places of the chosen ones
    joined, results attached. Only filters of at most ``filter_bits`` bits are
    broadcast beside what Spark's joins find small, and only documents that pass the
    filter of the texts found take part in the last join.
    """
    context = documents.sparkSession.sparkContext
    cut = written(benchmark_windows(benchmark, item, item_text, size), "benchmark-windows")
    windows = cut.drop("item").dropDuplicates(["window_id"])
    bounds = cut.agg(
        F.collect_set(F.least("n_window", F.lit(SHINGLE_WORDS))).alias("lengths"),
        F.max(F.octet_length("window")).alias("longest"),
    ).first()
    lengths = sorted(bounds.lengths)
    known = context.broadcast(filter_of(cut.select(F.explode("shingles").alias("shingle")), filter_bits))
    counts = shingle_counts(documents, text, lengths, known)
    chosen = written(_rarest(windows, counts), "rarest-shingles")
    known = context.broadcast(filter_of(chosen.select("shingle"), filter_bits))
    places = places_in_documents(documents, text, lengths, known, size, bounds.longest or 1)
    hits = written(_found(places, chosen), "windows-found")
    named = hits.select("digest", "window_id").distinct().join(cut.select("window_id", "item").distinct(), "window_id")
    none = F.lit(None)
    both = hits.select("digest", "span", none.cast("string").alias("item")).unionByName(
        named.select("digest", none.cast(hits.schema["span"].dataType).alias("span"), "item")
    )
    results = written(
        both.groupBy("digest").agg(
            F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")
        ),
        "contamination",
    )
    for table in (hits, chosen, cut):
        discard(table)
    return _attached(documents, results, text, filter_bits)


def _attached(documents: DataFrame, results: DataFrame, text: str, filter_bits: int) -> DataFrame:
    """The documents with their results; texts that can't have any are not shuffled."""
    known = documents.sparkSession.sparkContext.broadcast(
        filter_of(results.select(F.xxhash64("digest").alias("digest")), filter_bits)
    )

    @F.pandas_udf("boolean")
    def perhaps(hashed: pd.Series) -> pd.Series:
        return pd.Series(known.value.has(hashed.to_numpy(np.int64)))

    digest, maybe = fresh(documents, "_digest"), fresh(documents, "_perhaps")
    taken = ("n_words", "spans", "items")
    kept = [F.col(name) for name in documents.columns if name not in taken]
    rows = documents.select(
        *kept, word_count(text_bytes(text)).alias("n_words"), _digest(text).alias(digest)
    ).withColumn(maybe, perhaps(F.xxhash64(digest)))
    found = results.withColumnRenamed("digest", digest)
    spans, items = (F.lit(F.array()).cast(found.schema[name].dataType) for name in ("spans", "items"))
    clean = rows.where(~F.col(maybe)).withColumns({"spans": spans, "items": items})
    joined = rows.where(F.col(maybe)).join(found, digest, "left")
    joined = joined.withColumns({"spans": F.coalesce("spans", spans), "items": F.coalesce("items", items)})
    return clean.unionByName(joined).drop(digest, maybe)


def hit_words(spans: str = "spans"):
    """Words that lie in any span: the lengths beyond what earlier spans reached."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))

    def step(total, span):
        begin = F.greatest(span.start, total.reach)
        return F.struct(
            (total.n + F.greatest(span.end - begin, F.lit(0))).alias("n"),
            F.greatest(total.reach, span.end).alias("reach"),
        )

    return F.aggregate(F.array_sort(spans), start, step, lambda total: total.n)
