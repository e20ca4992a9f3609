"""Removing every byte that a repeated string of a given length covers.

The strings of `length` bytes are the suffixes of the texts cut to that depth. They
are put in groups of equal content from the most significant digit to the last,
and what is alone in its group leaves after each pass:

1. A string's first digit is its anchor: the leftmost of its 64-byte pieces with
   the smallest hash. Equal strings have equal anchors at equal offsets.
   Neighbouring strings with the same anchor form a run, about one for 69 bytes.
   Runs whose anchor occurs once hold no repeated string.
2. The second digit is the content of the whole run. Equal runs repeat in full.
   From here on one run stands for all equal ones.
3. Runs are cut into cells of 16 offsets from the anchor. A cell whose common part
   (the bytes that all its strings share) occurs once leaves; a cell whose whole
   content occurs twice repeats in full.
4. The strings of the remaining cells are compared one by one.

Groups are only ever counted, in aggregates combined before the shuffle, so a
passage in a third of all documents costs no task more than its share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiatus.llm.tables import discard, fresh, text_bytes, written

LENGTH = 200
#: Bytes of an anchor, as a share of the length: 64 of 200.
ANCHOR_SHARE = 0.32
CELL = 16
#: Strings looked at together; their places fit the low bits of a packed hash.
STRETCH = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _tables(count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value for each byte, and powers of the base and of its inverse."""
    if count not in _TABLES:
        values = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        _TABLES[count] = values, _powers(_MULTIPLIER, count), _powers(_INVERSE, count)
    return _TABLES[count]


def _piece_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A mixed polynomial hash of every piece of ``size`` bytes."""
    values, powers, inverse = _tables(STRETCH + 4096)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers[: len(data)], out=sums[1:])
    hashes = (sums[size:] - sums[:-size]) * inverse[: len(data) - size + 1]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    return hashes


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` values in a row, by doubling."""
    covered, lows = 1, values
    while 2 * covered <= width:
        lows = np.minimum(lows[:-covered], lows[covered:])
        covered *= 2
    rest = width - covered
    return np.minimum(lows[: len(lows) - rest], lows[rest:]) if rest else lows


def runs(text: bytes, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first string, last string, anchor) of every run of a text, as places."""
    data = np.frombuffer(text, dtype=np.uint8)
    firsts, lasts, anchors = [], [], []
    for start in range(0, len(data) - length + 1, STRETCH):
        part = data[start : start + STRETCH + length - 1]
        packed = _piece_hashes(part, anchor)
        packed = (packed & ~_PLACE) | np.arange(len(packed), dtype=np.uint64)
        at = (_sliding_minimum(packed, length - anchor + 1) & _PLACE).astype(np.int64)
        cuts = np.flatnonzero(np.diff(at)) + 1
        firsts.append(np.concatenate([[0], cuts]) + start)
        lasts.append(np.concatenate([cuts - 1, [len(at) - 1]]) + start)
        anchors.append(at[np.concatenate([[0], cuts])] + start)
    empty = [np.zeros(0, dtype=np.int64)]
    first, last, at = (np.concatenate(x or empty) for x in (firsts, lasts, anchors))
    opens = np.flatnonzero(np.diff(at, prepend=-1))  # a run may go on in the next stretch
    closes = np.append(opens[1:], len(at)) - 1
    return first[opens], last[closes], at[opens]


def _digests(text: bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(text[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())),
        dtype=np.uint64,
        count=len(starts),
    ).view(np.int64)


def _all_runs(documents: DataFrame, key: str, text: str, length: int, anchor: int) -> DataFrame:
    """A row for each run of each text: its place, and hashes of anchor and content."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                which, columns = [], [[], [], [], [], []]
                for row in range(low, min(low + 256, batch.num_rows)):
                    content = batch.column(1)[row].as_py()
                    if len(content) < length:
                        continue
                    first, last, at = runs(content, length, anchor)
                    which.append(np.full(len(first), row))
                    digests = _digests(content, at, at + anchor, 1), _digests(content, first, last + length, 2)
                    for column, part in zip(columns, (*digests, first, last, at)):
                        column.append(part)
                if which:
                    arrays = [batch.column(0).take(pa.array(np.concatenate(which)))]
                    arrays += [pa.array(np.concatenate(c)) for c in columns[:2]]
                    arrays += [pa.array(np.concatenate(c).astype(np.int32)) for c in columns[2:]]
                    yield pa.RecordBatch.from_arrays(
                        arrays, names=["key", "anchor", "whole", "first", "last", "place"]
                    )

    return documents.select(key, text_bytes(text).alias("text")).mapInArrow(
        cut, "key binary, anchor long, whole long, first int, last int, place int"
    )


def _repeated(rows: DataFrame, digit: list[str], content: str) -> DataFrame:
    """Rows whose digit occurs twice, with ``several``: does its content differ?"""
    groups = written(
        rows.groupBy(*digit)
        .agg(F.count("*").alias("_rows"), (F.min(content) != F.max(content)).alias("several"))
        .where("_rows > 1")
        .select(*digit, "several"),
        "digits",
    )
    return rows.join(groups, digit)


def _contexts(documents: DataFrame, key: str, text: str, classes: DataFrame, length: int, margin: int) -> DataFrame:
    """The bytes around one run of each class, cut out of the texts."""
    wanted = written(
        classes.groupBy("key").agg(
            F.collect_list(F.struct("anchor", "whole", "single", "first", "last", "place")).alias("runs")
        ),
        "wanted",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                lists = part.column(2)
                rows = np.repeat(np.arange(part.num_rows), pa.compute.list_value_length(lists).to_numpy(False))
                fields = lists.flatten()
                first, last = (fields.field(x).to_numpy().astype(np.int64) for x in ("first", "last"))
                contents = [x.as_py() for x in part.column(1)]
                sizes = np.array([len(x) for x in contents])[rows]
                base = np.maximum(first - margin, 0)
                ends = np.minimum(last + margin + length, sizes)
                cuts = [contents[r][a:b] for r, a, b in zip(rows.tolist(), base.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows))]
                    + [fields.field(x) for x in ("anchor", "whole", "single", "first", "last", "place")]
                    + [pa.array(base.astype(np.int32)), pa.array(cuts, type=pa.binary())],
                    names=["key", "anchor", "whole", "single", "first", "last", "place", "base", "context"],
                )

    return (
        documents.select(F.col(key).alias("key"), text_bytes(text).alias("text"))
        .join(wanted, "key")
        .select("key", "text", "runs")
        .mapInArrow(
            cut,
            "key binary, anchor long, whole long, single boolean, first int, last int, place int, base int, context binary",
        )
    )


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, turn) of ``counts[row]`` entries for each row."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


def _cut_digests(contents: list[bytes], rows, starts, ends, seed: int) -> np.ndarray:
    """The hash of a part of ``contents[row]`` for each row."""
    digest = xxhash.xxh64_intdigest
    parts = zip(rows.tolist(), starts.tolist(), ends.tolist())
    return np.fromiter(
        (digest(contents[r][a:b], seed) for r, a, b in parts), dtype=np.uint64, count=len(rows)
    ).view(np.int64)


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy().astype(np.int64) for n in names]


def _small(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int32))


def _cells(contexts: DataFrame, length: int, size: int) -> DataFrame:
    """The cells of each run, with hashes of their common and their whole content.

    Hashes cover the whole width of a cell. ``low`` and ``high`` are the strings of
    the run in it, the same ones in cells of equal content, since a string's anchor
    depends on its own bytes. So every string of a text is looked at once, also
    where an anchor comes back a few bytes further on.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 2048):
                batch = whole_batch.slice(start, 2048)
                first, last, place, base = _numbers(batch, "first", "last", "place", "base")
                contents = batch.column("context").to_pylist()
                most = base + np.array([len(x) for x in contents]) - length
                near = (place - last) // size
                rows, turn = _spread((place - first) // size - near + 1)
                cell = near[rows] + turn
                high = place[rows] - cell * size
                low = high - size + 1
                base = base[rows]
                inner_low, inner_high = np.maximum(low, base), np.minimum(high, most[rows])
                common = _cut_digests(contents, rows, high - base, low + length - base, 3)
                whole = _cut_digests(contents, rows, inner_low - base, inner_high + length - base, 4)
                # cells cut short by a text's ends equal only cells that are cut alike
                whole ^= (inner_low - low) ^ ((high - inner_high) << 16)
                # strings beyond the run have another anchor and are judged in their own run
                inner_low, inner_high = np.maximum(low, first[rows]), np.minimum(high, last[rows])
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n).take(take) for n in ("key", "anchor", "whole", "single")]
                    + [_small(cell), pa.array(common), pa.array(whole), _small(inner_low), _small(inner_high)],
                    names=["key", "anchor", "run", "single", "cell", "common", "whole", "low", "high"],
                )

    return contexts.mapInArrow(
        cut,
        "key binary, anchor long, run long, single boolean, cell int, common long, whole long, low int, high int",
    )


def _strings(contexts: DataFrame, cell_classes: DataFrame, length: int) -> DataFrame:
    """Every string of one cell of each class; ``single`` if no other cell equals it."""
    chosen = cell_classes.select("anchor", F.col("run").alias("whole"), "low", "high", "alone").distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 2048):
                batch = whole_batch.slice(start, 2048)
                low, high, base = _numbers(batch, "low", "high", "base")
                contents = batch.column("context").to_pylist()
                rows, turn = _spread(high - low + 1)
                at = low[rows] + turn
                string = _cut_digests(contents, rows, at - base[rows], at - base[rows] + length, 5)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n).take(take) for n in ("key", "anchor", "single")]
                    + [pa.array(string), _small(at)],
                    names=["key", "anchor", "single", "string", "at"],
                )

    return (
        contexts.join(chosen, ["anchor", "whole"])
        .select(
            "key", "anchor", (F.col("single") & F.col("alone")).alias("single"), "base", "context", "low", "high"
        )
        .mapInArrow(cut, "key binary, anchor long, single boolean, string long, at int")
    )


def repeated_spans(documents: DataFrame, key: str, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(key, spans) of the texts that hold repeated strings.

    ``key`` is a binary column that stands for the text's content. A span is
    (start, end) in bytes, the end excluded; spans may touch and overlap.
    """
    anchor = max(1, int(length * ANCHOR_SHARE))
    size = max(1, min(CELL, length // 4))
    every = written(_all_runs(documents, key, text, length, anchor), "runs")
    found = written(_repeated(every, ["anchor"], "whole"), "repeated-runs")
    discard(every)
    span = ("key", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    several = found.where("several")
    classes = written(
        several.groupBy("anchor", "whole")
        .agg(F.count("*").alias("_rows"), F.min(F.struct("key", "first", "last", "place")).alias("_one"))
        .select("anchor", "whole", (F.col("_rows") == 1).alias("single"), "_one.*"),
        "classes",
    )
    contexts = written(_contexts(documents, key, text, classes, length, size), "contexts")
    every = written(_cells(contexts, length, size), "all-cells")
    cells = written(_repeated(every, ["anchor", "cell", "common"], "whole"), "cells")
    discard(every)
    pending = cells.where("several")
    cell_classes = written(
        pending.groupBy("anchor", "cell", "whole")
        .agg((F.count("*") == 1).alias("alone"), F.min(F.struct("run", "low", "high")).alias("_one"))
        .select("anchor", "cell", "whole", "alone", "_one.*"),
        "cell-classes",
    )
    strings = written(_strings(contexts, cell_classes, length), "strings")
    discard(contexts)
    twice = written(
        strings.groupBy("anchor", "string").agg(F.count("*").alias("_rows")).where("_rows > 1").drop("_rows"),
        "equal-strings",
    )
    same = ["anchor", "cell", "whole"]
    cell_span = ("key", F.col("low").alias("start"), (F.col("high") + length).alias("end"))
    spans = (
        found.where("NOT several")
        .select(*span)
        .union(several.join(classes.where("NOT single").select("anchor", "whole"), ["anchor", "whole"], "left_semi").select(*span))
        .union(cells.where("single AND NOT several").select(*cell_span))
        .union(pending.where("single").join(cell_classes.where("NOT alone"), same, "left_semi").select(*cell_span))
        .union(
            strings.where("single")
            .join(twice, ["anchor", "string"], "left_semi")
            .select("key", F.col("at").alias("start"), (F.col("at") + length).alias("end"))
        )
    )
    return spans.distinct().groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def cut_spans(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], int]:
    """The pieces left of a text without the spans, and how many runs they make."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    opens = np.concatenate([[True], starts[1:] > reach[:-1]])
    starts, ends = starts[opens], reach[np.concatenate([opens[1:], [True]])]
    edges = zip([0, *ends.tolist()], [*starts.tolist(), len(text)])
    return [text[a:b] for a, b in edges], len(starts)


def remove_repeats(
    documents: DataFrame, text: str = "text", length: int = LENGTH, whole_characters: bool = False
) -> DataFrame:
    """Every document with the bytes left after removing repeated strings.

    A byte goes when a string of ``length`` bytes that covers it also starts
    anywhere else, in the same text or another; this is judged on the input.
    Adds ``kept`` (binary), ``n_bytes``, ``n_removed`` and ``n_spans`` (runs of
    removed bytes), replacing columns of these names. With ``whole_characters``
    what is left of a character that a cut went through goes from ``kept`` too,
    which then is UTF-8 again. A null text counts as empty; texts shorter than
    ``length`` lose nothing. Repeated rows repeat each other and each gets the
    same result. No rows give no rows.
    """
    ours = ("kept", "n_bytes", "n_removed", "n_spans")
    base = documents.drop(*[c for c in ours if c != text])
    key = fresh(base, "_key")
    keyed = base.withColumn(key, F.unhex(F.md5(text_bytes(text))))
    spans = written(repeated_spans(keyed, key, text, length), "spans")

    @F.arrow_udf("kept binary, n_removed long, n_spans long")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, starts, ends in batches:
            left, removed, runs_cut = [], [], []
            for content, start, end in zip(texts, starts, ends):
                whole = content.as_py()
                pieces, count = [whole], 0
                if start.is_valid and len(start):
                    pieces, count = cut_spans(whole, start.values.to_numpy(), end.values.to_numpy())
                removed.append(len(whole) - sum(map(len, pieces)))
                runs_cut.append(count)
                if count and whole_characters:  # piece by piece: halves of two characters would make a third
                    pieces = [x.decode("utf-8", "ignore").encode() for x in pieces]
                left.append(b"".join(pieces))
            yield pa.StructArray.from_arrays(
                [pa.array(left, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs_cut, pa.int64())],
                names=["kept", "n_removed", "n_spans"],
            )

    joined = keyed.join(
        spans.select(
            F.col("key").alias(key), F.col("spans.start").alias(f"{key}_s"), F.col("spans.end").alias(f"{key}_e")
        ),
        key,
        "left",
    )
    out = joined.withColumn(f"{key}_r", cut(text_bytes(text), F.col(f"{key}_s"), F.col(f"{key}_e")))
    return out.select(
        *base.columns,
        F.col(f"{key}_r.kept").alias("kept"),
        F.octet_length(text_bytes(text)).cast("long").alias("n_bytes"),
        F.col(f"{key}_r.n_removed").alias("n_removed"),
        F.col(f"{key}_r.n_spans").alias("n_spans"),
    )
