"""Scoring texts by all segmentations of their words into existing pieces."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiatus.llm.tables import fresh, text_bytes, written

#: Words that a task counts before it passes the counts on.
COUNTED_WORDS = 300_000
#: The most frequent words are scored where the texts are read: a table of this
#: many rows, whatever the corpus. All other words are joined by shuffle.
HEAD_WORDS = 1 << 16
END = " end"  # no word holds a space
_START = "▁"


def tokens(text: bytes) -> list[bytes]:
    """Words between ASCII white space, with A-Z lowered."""
    return text.lower().split()


class Lattice:
    """Log-probabilities of a vocabulary's pieces, summed over segmentations."""

    def __init__(self, pieces: dict[str, float], octets: list[float]):
        self.pieces, self.octets = pieces, octets
        self.longest = max(map(len, pieces), default=1)

    def log10(self, word: bytes) -> float:
        """Marginal log10 probability of a word.

        ``forward[i]`` is the log of the summed probability of all segmentations of
        the first i characters. Any character may also be spelt by its bytes.
        """
        text = _START + word.decode("utf-8", "replace")
        pieces, longest, count = self.pieces, self.longest, len(text)
        incoming: list[list[float]] = [[] for _ in range(count + 1)]
        incoming[0].append(0.0)
        for start in range(count):
            terms = incoming[start]
            incoming[start] = ()
            if len(terms) == 1:
                here = terms[0]
            else:
                top = max(terms)
                here = top + math.log(sum([math.exp(x - top) for x in terms]))
            character = text[start]
            incoming[start + 1].append(here + sum([self.octets[b] for b in character.encode()]))
            for end in range(start + 1, min(start + longest, count) + 1):
                weight = pieces.get(text[start:end])
                if weight is not None:
                    incoming[end].append(here + weight)
        terms = incoming[count]
        top = max(terms)
        return (top + math.log(sum([math.exp(x - top) for x in terms]))) / math.log(10)


def _held_out(ident: str):
    return F.coalesce(F.pmod(F.crc32(F.col(ident).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def word_counts(documents: DataFrame, text: str, held_out) -> DataFrame:
    """(word, n, trained): how often a word stands in all and in training texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every, trained = Counter(), Counter()

        def taken() -> pd.DataFrame:
            words = list(every)
            frame = pd.DataFrame(
                {"word": words, "n": [every[w] for w in words], "trained": [trained[w] for w in words]}
            )
            every.clear()
            trained.clear()
            return frame

        end = END.encode()
        for batch in batches:
            for content, held in zip(batch["text"], batch["held"]):
                found = tokens(content)
                every.update(found)
                every[end] += 1
                if not held:
                    trained.update(found)
                    trained[end] += 1
                if len(every) >= COUNTED_WORDS:
                    yield taken()
        yield taken()

    counted = documents.select(text_bytes(text).alias("text"), held_out.alias("held")).mapInPandas(
        count, "word binary, n long, trained long"
    )
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("trained").alias("trained"))


def piece_weights(words: DataFrame, vocabulary: str) -> tuple[Lattice, float]:
    """The pieces' log-probabilities, and that of a text's end.

    The vocabulary is an existing one; its pieces' scores are the logs of their
    shares in the training words, each cut by the vocabulary's own best
    segmentation, with one added to every count. There is a count for each piece,
    so what comes to the driver has the vocabulary's size.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        totals = np.zeros(model.get_piece_size(), dtype=np.int64)
        for batch in batches:
            for start in range(0, len(batch), 4096):
                part = batch[start : start + 4096]
                found = model.encode([w.decode("utf-8", "replace") for w in part["word"]], num_threads=1)
                sizes = [len(x) for x in found]
                if sum(sizes):
                    np.add.at(totals, np.concatenate(found).astype(np.int64), np.repeat(part["trained"].to_numpy(), sizes))
        used = np.flatnonzero(totals)
        yield pd.DataFrame({"piece": used, "n": totals[used]})

    counted = (
        words.where((F.col("trained") > 0) & (F.col("word") != F.lit(END.encode())))
        .select("word", "trained")
        .mapInPandas(cut, "piece long, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
    )
    texts = words.where(F.col("word") == F.lit(END.encode())).agg(F.sum("trained")).first()[0] or 0
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    totals = np.ones(model.get_piece_size())
    for row in counted.collect():
        totals[row.piece] += row.n
    usable = [
        i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    whole = math.log(totals[usable].sum() + texts + 1)
    pieces, octets = {}, [0.0] * 256
    for i in usable:
        weight = math.log(totals[i]) - whole
        if model.is_byte(i):
            octets[int(model.id_to_piece(i)[3:-1], 16)] = weight
        else:
            pieces[model.id_to_piece(i)] = weight
    return Lattice(pieces, octets), (math.log(texts + 1) - whole) / math.log(10)


def score_texts(documents: DataFrame, vocabulary: str, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Every document with its probability under a piece lattice and a word model.

    Adds ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score``, replacing columns of these names and dropping the text. Both models
    learn from documents whose crc32(id) mod 7 is not 2; a null id is training. Pieces
    never span white space, so a text's probability over all segmentations is the
    product of its words', each computed once for the whole corpus.

    ``vocabulary`` is the path of a sentencepiece file on every executor. A null text
    is empty, and has the end alone as token. Repeated rows each get their result.
    No rows give no rows; without training texts every word counts as unknown.
    """
    ours = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    base = documents.drop(*[c for c in ours if c not in (text, ident)])
    kept = [c for c in base.columns if c != text]
    held = _held_out(ident)
    spark = documents.sparkSession
    counted = written(word_counts(base, text, held), "word-counts")
    facts = counted.agg(
        F.coalesce(F.sum("trained"), F.lit(0)).alias("n"), F.count_if(F.col("trained") > 0).alias("v")
    ).first()
    lattice, end_score = piece_weights(counted, vocabulary)
    shared = spark.sparkContext.broadcast(lattice)
    end = END.encode()

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([end_score if w == end else shared.value.log10(w) for w in batch], dtype="float64")

    weights = written(
        counted.select("word", "n", "trained", F.pandas_udf(scored, "double")("word").alias("log10")), "word-scores"
    )
    head = {
        bytes(r.word): (r.trained, r.log10)
        for r in weights.orderBy(F.desc("n"), "word").limit(HEAD_WORDS).select("word", "trained", "log10").collect()
    }
    frequent = spark.sparkContext.broadcast(head)

    def looked_up(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = frequent.value
        for batch in batches:
            rows = []
            for content in batch:
                found = Counter(tokens(content))
                found[end] += 1
                total, seen, logs, score, rest = 0, 0, 0.0, 0.0, []
                for word, times in found.items():
                    total += times
                    pair = known.get(word)
                    if pair is None:
                        rest.append((word, times))
                    else:
                        trained, log10 = pair
                        seen += times * (trained > 0)
                        logs += times * math.log10(trained + 1)
                        score += times * log10
                rows.append((total, seen, logs, score, [w for w, _ in rest], [n for _, n in rest]))
            yield pd.DataFrame(rows, columns=["total", "seen", "logs", "score", "words", "times"])

    look = F.pandas_udf(
        looked_up, "total long, seen long, logs double, score double, words array<binary>, times array<long>"
    )
    row, data, name = fresh(base, "_row"), fresh(base, "_found"), fresh(base, "_kept")
    read = base.select(
        F.monotonically_increasing_id().alias(row),
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)], held.alias("held")).alias(name),
        look(text_bytes(text)).alias(data),
    )
    own = F.struct(F.lit(None).cast("binary").alias("word"), F.lit(0).cast("long").alias("times"))
    rare = F.transform(
        F.arrays_zip(F.col(f"{data}.words").alias("word"), F.col(f"{data}.times").alias("times")),
        lambda x: F.struct(x.word.alias("word"), x.times.alias("times")),
    )
    lines = read.withColumn("_w", F.explode(F.concat(F.array(own), rare)))
    first = F.col("_w.word").isNull()
    lines = lines.select(
        row,
        F.when(first, F.col(name)).alias(name),
        # a key that no word has, and another one for each row
        F.when(first, F.concat(F.lit(" ").cast("binary"), F.col(row).cast("string").cast("binary")))
        .otherwise(F.col("_w.word"))
        .alias("word"),
        "_w.times",
        *[F.when(first, F.col(f"{data}.{c}")).alias(c) for c in ("total", "seen", "logs", "score")],
    )
    joined = lines.join(weights.select("word", "trained", "log10"), "word", "left")
    times = F.col("times")
    summed = joined.groupBy(row).agg(
        F.any_value(name, ignoreNulls=True).alias(name),
        F.max("total").alias("total"),
        F.sum(F.coalesce("seen", F.when(F.col("trained") > 0, times), F.lit(0))).alias("seen"),
        F.sum(F.coalesce("logs", times * F.log10(F.col("trained") + 1))).alias("logs"),
        F.sum(F.coalesce("score", times * F.col("log10"))).alias("score"),
    )
    space = math.log10(facts.n + facts.v + 1)
    return summed.select(
        *[F.col(f"{name}.c{i}").alias(c) for i, c in enumerate(kept)],
        F.col(f"{name}.held").alias("held_out"),
        F.col("total").alias("n_tokens"),
        F.col("seen").alias("n_known"),
        F.lit(facts.n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("total") * F.lit(space)).alias("base_score"),
        "score",
    )
