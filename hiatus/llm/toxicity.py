"""Toxicity by a chain of linear classifiers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiatus.llm.decontamination import words
from hiatus.llm.tables import fresh, text_bytes

#: Labelled documents that the models are fitted on, at most.
TRAIN_ROWS = 10_000
FEATURES = 1 << 16
FOLDS = 3
ROUNDS = 120
#: Probability from which a document is rejected.
THRESHOLD = 0.6
#: A feature takes part if a category's rows hold it this many standard errors
#: more or less often than the others; what is left out carries no weight.
LEAST_Z = 4.0


def _feature(word: bytes) -> tuple[int, int]:
    """Hashed features of a word: the word itself and its first four bytes."""
    return xxhash.xxh32_intdigest(word, 1) % FEATURES, xxhash.xxh32_intdigest(word[:4], 2) % FEATURES


class Features:
    """Distinct features of texts; words are hashed once and kept, up to a bound."""

    def __init__(self, use: np.ndarray | None = None, most: int = 200_000):
        self.known: dict[bytes, tuple[int, ...]] = {}
        self.use = np.ones(FEATURES, dtype=bool) if use is None else use
        self.most = most

    def of(self, text: bytes) -> np.ndarray:
        known, places = self.known, []
        for word in set(words(text)):
            kept = known.get(word)
            if kept is None:
                if len(known) >= self.most:
                    known.clear()
                kept = known[word] = tuple(x for x in _feature(word) if self.use[x])
            places.extend(kept)
        return np.unique(np.array(places, dtype=np.int64))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All rows' features, and the row of each."""
    return (
        np.concatenate([np.zeros(0, dtype=np.int64), *rows]),
        np.repeat(np.arange(len(rows)), [len(x) for x in rows]),
    )


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def telling(places, rows, target, use) -> np.ndarray:
    """Which features the used rows of a category hold unusually often or seldom."""
    inside, outside = use * target, use * (1 - target)
    ours, theirs = max(1.0, inside.sum()), max(1.0, outside.sum())
    held = np.bincount(places, weights=inside[rows], minlength=FEATURES)
    other = np.bincount(places, weights=outside[rows], minlength=FEATURES)
    rate = (held + other + 1) / (ours + theirs + 2)
    error = np.sqrt(rate * (1 - rate) * (1 / ours + 1 / theirs))
    return np.abs(held / ours - other / theirs) > LEAST_Z * error


def _score(weights, places, rows, extra) -> np.ndarray:
    margin = np.bincount(rows, weights=weights[places], minlength=len(extra))
    return _logistic(margin + extra @ weights[FEATURES:-1] + weights[-1])


def fit(places, rows, extra, target, use, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of a balanced logistic model: features, earlier categories, bias.

    Full-batch Adam with a fixed number of rounds over the telling features of the
    rows in ``use``.
    """
    free = np.concatenate([telling(places, rows, target, use), np.ones(extra.shape[1] + 1, dtype=bool)])
    told = free[places]
    places, rows = places[told], rows[told]
    weights, first, second = (np.zeros(len(free)) for _ in range(3))
    positive, negative = max(1.0, (use * target).sum()), max(1.0, (use * (1 - target)).sum())
    importance = use * np.where(target > 0, 0.5 / positive, 0.5 / negative)
    for turn in range(1, rounds + 1):
        error = importance * (_score(weights, places, rows, extra) - target)
        gradient = np.concatenate(
            [np.bincount(places, weights=error[rows], minlength=FEATURES), extra.T @ error, [error.sum()]]
        )
        gradient[:FEATURES] += 1e-5 * weights[:FEATURES]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        pace = 0.2 * (1 - turn / (rounds + 1)) / (1 - 0.9**turn)
        weights -= free * pace * first / (np.sqrt(second / (1 - 0.99**turn)) + 1e-9)
    return weights


def fit_chain(held_features: list[np.ndarray], fold: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Weights of each category's model, one row each, zero-padded.

    A category's model sees the probabilities of the categories before it. In
    training these come from models that have not seen the row (out of fold), as
    they will when the chain is applied.
    """
    places, rows = _flat(held_features)
    count, categories = targets.shape
    extra = np.zeros((count, 0))
    chain = np.zeros((categories, FEATURES + categories))
    for category in range(categories):
        target = targets[:, category].astype(float)
        weights = fit(places, rows, extra, target, np.ones(count))
        chain[category, : FEATURES + category] = weights[:-1]
        chain[category, -1] = weights[-1]
        if category < categories - 1:
            held = np.zeros(count)
            for part in range(FOLDS):
                own = fit(places, rows, extra, target, (fold != part).astype(float))
                held = np.where(fold == part, _score(own, places, rows, extra), held)
            extra = np.column_stack([extra, held])
    return chain


def features_in(chain: np.ndarray) -> Features:
    """Features that look only for those with a weight."""
    return Features((chain[:, :FEATURES] != 0).any(axis=0))


def apply_chain(chain: np.ndarray, texts: list[bytes], features: Features) -> np.ndarray:
    """The probability of each category for each text."""
    places, rows = _flat([features.of(x) for x in texts])
    scores = np.zeros((len(texts), 0))
    for category, weights in enumerate(chain):
        own = np.concatenate([weights[: FEATURES + category], weights[-1:]])
        scores = np.column_stack([scores, _score(own, places, rows, scores)])
    return scores


def train(documents: DataFrame, labels: DataFrame, categories: Sequence[str], text: str, ident: str, most: int) -> np.ndarray | None:
    """Fits the chain in one task on at most ``most`` labelled documents.

    Ids are drawn by their hash; a document's label is 1 if any of its label rows
    says so. Rows that share an id count once, with the smallest text, combined
    before the shuffle. The fitting task receives the numbers of distinct features
    alone, never texts. Returns None without labelled documents.
    """
    labelled = (
        labels.where(F.col(ident).isNotNull())
        .groupBy(F.col(ident).alias("_id"))
        .agg(*[F.max(F.coalesce(F.col(c).cast("int"), F.lit(0))).alias(c) for c in categories])
    )
    chosen = labelled.orderBy(F.xxhash64(F.col("_id"), F.lit(5)), "_id").limit(most)
    names = list(categories)
    sample = (
        documents.select(F.col(ident).alias("_id"), text_bytes(text).alias("_text"))
        .join(F.broadcast(chosen), "_id")
        .groupBy("_id")
        .agg(F.min("_text").alias("_text"), *[F.max(c).alias(c) for c in names])
    )

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            yield pd.DataFrame(
                {
                    "order": batch["_id"],
                    "fold": [xxhash.xxh32_intdigest(x, 3) % FOLDS for x in batch["_text"]],
                    "features": [features.of(x).astype(np.int32) for x in batch["_text"]],
                    "targets": list(batch[names].to_numpy(dtype=np.int32)),
                }
            )

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("order")
        chain = fit_chain(
            [np.asarray(x, dtype=np.int64) for x in group["features"]],
            group["fold"].to_numpy(),
            np.stack(group["targets"].to_list()),
        )
        return pd.DataFrame({"chain": [chain.astype(np.float64).tobytes()]})

    kind = sample.schema["_id"].dataType.simpleString()
    rows = (
        sample.mapInPandas(featured, f"order {kind}, fold int, features array<int>, targets array<int>")
        .withColumn("_all", F.lit(1))
        .groupBy("_all")
        .applyInPandas(fitted, "chain binary")
        .collect()
    )
    if not rows:
        return None
    return np.frombuffer(rows[0].chain, dtype=np.float64).reshape(len(categories), -1)


def toxicity(
    documents: DataFrame,
    labels: DataFrame,
    categories: Sequence[str] = ("toxic",),
    text: str = "text",
    ident: str = "doc_id",
    threshold: float = THRESHOLD,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """Every document with the probability of each category, in chain order.

    Adds ``p_<category>`` and ``rejected`` (the last category's probability reaches
    the threshold), replacing columns of these names. Whole texts are read. Null and empty texts get the models'
    bias. Without labelled documents all probabilities are 0. Repeated rows and
    ids each get their result. No rows give no rows.
    """
    names = [f"p_{c}" for c in categories]
    base = documents.drop(*[c for c in (*names, "rejected") if c not in (text, ident)])
    chain = train(documents, labels, categories, text, ident, train_rows)
    if chain is None:
        scored = base
        for name in names:
            scored = scored.withColumn(name, F.lit(0.0))
        return scored.withColumn("rejected", F.lit(False))
    shared = documents.sparkSession.sparkContext.broadcast(chain)
    result = fresh(base, "_p")

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = features_in(shared.value)
        for batch in batches:
            parts = [
                apply_chain(shared.value, list(batch[i : i + 256]), features) for i in range(0, len(batch), 256)
            ]
            yield pd.DataFrame(np.concatenate(parts) if parts else np.zeros((0, len(names))), columns=names)

    scored = base.withColumn(result, score(text_bytes(text)))
    return scored.select(
        *base.columns,
        *[F.col(f"{result}.{n}").alias(n) for n in names],
        (F.col(f"{result}.{names[-1]}") >= threshold).alias("rejected"),
    )
