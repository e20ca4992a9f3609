"""Token counts by byte-pair merging with a heap and a linked list."""

from __future__ import annotations

import heapq
import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiatus.llm.tables import text_bytes

LIMIT = 512
#: Pieces whose count a task remembers, and the longest piece that it does.
KNOWN_PIECES, KNOWN_LENGTH = 400_000, 64

# Fixed value: how byte-level vocabularies cut a text into pieces.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Merges:
    """The merge ranks of a byte-level vocabulary file, and its special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        pairs = described["model"]["merges"]
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in pairs]
        number: dict[str, int] = {symbol: byte for byte, symbol in enumerate(_byte_symbols())}
        for left, right in pairs:
            number.setdefault(left + right, len(number))
        self.rank = {(number[a], number[b]): (order, number[a + b]) for order, (a, b) in enumerate(pairs)}
        special = sorted((x["content"] for x in described["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: dict[str, int] = {}

    def merged(self, piece: bytes) -> int:
        """Tokens of one piece: its bytes less the merges made.

        The heap holds the rank and place of adjacent pairs; the lowest is merged
        first, the leftmost among equals. Symbols are linked to their neighbours,
        and an entry whose symbols have changed since is passed over.
        """
        rank = self.rank
        symbol = list(piece)
        count = len(symbol)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        heap = []
        for at in range(count - 1):
            found = rank.get((symbol[at], symbol[at + 1]))
            if found:
                heap.append((found[0], at, symbol[at], symbol[at + 1], found[1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, at, left, right, joined = heapq.heappop(heap)
            other = after[at]
            if symbol[at] != left or other >= count or symbol[other] != right:
                continue
            merges += 1
            symbol[at], symbol[other] = joined, -1
            after[at] = follower = after[other]
            if follower < count:
                before[follower] = at
                found = rank.get((joined, symbol[follower]))
                if found:
                    heapq.heappush(heap, (found[0], at, joined, symbol[follower], found[1]))
            leader = before[at]
            if leader >= 0:
                found = rank.get((symbol[leader], joined))
                if found:
                    heapq.heappush(heap, (found[0], leader, symbol[leader], joined, found[1]))
        return count - merges

    def _ordinary(self, text: str) -> int:
        total, known = 0, self.known
        for piece, times in Counter(PIECES.findall(text)).items():
            tokens = known.get(piece)
            if tokens is None:
                tokens = self.merged(piece.encode())
                if len(piece) <= KNOWN_LENGTH:
                    if len(known) >= KNOWN_PIECES:
                        known.clear()
                    known[piece] = tokens
            total += tokens * times
        return total

    def count(self, text: str) -> int:
        """Tokens of a text; each special string in it is one token."""
        if self.special is None:
            return self._ordinary(text)
        total, start = 0, 0
        for found in self.special.finditer(text):
            total += 1 + self._ordinary(text[start : found.start()])
            start = found.end()
        return total + self._ordinary(text[start:] if start else text)


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    """One copy for a Python worker, whose known pieces serve its later tasks too."""
    return Merges(path)


def token_counts(documents: DataFrame, vocabulary: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Every document with ``n_bytes``, ``n_tokens`` and ``over_limit`` (replaced if there).

    ``vocabulary`` is the path of a byte-level BPE file that every executor has. A
    null text is empty and an empty text has no tokens. Repeated rows each get
    their result; no rows give no rows. A piece of any length is merged whole.
    """

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        merges = merges_of(vocabulary)
        for batch in batches:
            yield pd.Series([merges.count(x) for x in batch], dtype="int64")

    base = documents.drop(*[c for c in ("n_bytes", "n_tokens", "over_limit") if c != text])
    return (
        base.withColumn("n_bytes", F.octet_length(text_bytes(text)).cast("long"))
        .withColumn("n_tokens", count(F.coalesce(F.col(text), F.lit(""))))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
