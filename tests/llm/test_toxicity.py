"""The classifier chain against a plain one that shares no code with it, and on held-out rows."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from hiatus.llm.toxicity import toxicity

BUCKETS, FOLDS, ROUNDS, LEAST_Z = 65_536, 3, 120, 4.0


def plain_features(text: str | None) -> set[int]:
    lowered = re.sub(rb"[A-Z]", lambda m: bytes([m[0][0] + 32]), (text or "").encode())
    found = set()
    for word in re.findall(rb"[0-9a-z\x80-\xff]+", lowered):
        found |= {xxhash.xxh32(word, 1).intdigest() % BUCKETS, xxhash.xxh32(word[:4], 2).intdigest() % BUCKETS}
    return found


def sigmoid(margin):
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def plain_fit(held, earlier, target):
    """Weights of features, earlier categories and bias, over dense columns."""
    ours, theirs = max(1, target.sum()), max(1, (1 - target).sum())
    a, b = held[target == 1].sum(axis=0), held[target == 0].sum(axis=0)
    rate = (a + b + 1) / (ours + theirs + 2)
    told = np.abs(a / ours - b / theirs) > LEAST_Z * np.sqrt(rate * (1 - rate) * (1 / ours + 1 / theirs))
    design = np.hstack([held * told, earlier, np.ones((len(held), 1))])
    weigh = np.where(target == 1, 0.5 / ours, 0.5 / theirs)
    decay = np.zeros(design.shape[1])
    decay[: held.shape[1]] = 1e-5
    weights, mean, square = (np.zeros(design.shape[1]) for _ in range(3))
    for turn in range(1, ROUNDS + 1):
        slope = design.T @ (weigh * (sigmoid(design @ weights) - target)) + decay * weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        step = (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-9)
        weights = weights - 0.2 * (1 - turn / (ROUNDS + 1)) * step
    return weights


def plain_chain(texts, labelled, targets):
    """Probability of each category for every text, fitted on the labelled ones."""
    sets = [plain_features(t) for t in texts]
    columns = sorted(set().union(*(sets[i] for i in labelled)))
    held = np.array([[float(c in s) for c in columns] for s in sets])
    fold = np.array([xxhash.xxh32((texts[i] or "").encode(), 3).intdigest() % FOLDS for i in labelled])
    train, before, result = held[labelled], np.zeros((len(labelled), 0)), np.zeros((len(texts), 0))
    for target in np.array(targets, dtype=float).T:
        weights = plain_fit(train, before, target)
        out_of_fold = np.zeros(len(labelled))
        for part in range(FOLDS):
            seen = fold != part
            own = plain_fit(train[seen], before[seen], target[seen])
            mine = np.hstack([train, before, np.ones((len(train), 1))])[~seen]
            out_of_fold[~seen] = sigmoid(mine @ own)
        result = np.column_stack([result, sigmoid(np.hstack([held, result, np.ones((len(held), 1))]) @ weights)])
        before = np.column_stack([before, out_of_fold])
    return result


def corpus(seed: int, count: int):
    """Texts whose rude words make them insults often and toxic always."""
    draw = random.Random(seed)
    plain, rude = [f"word{i}" for i in range(60)], ["Vile", "nasty", "rotten", "foul", "wretch"]
    rows = []
    for _ in range(count):
        toxic = draw.random() < 0.3
        insult = draw.random() < (0.8 if toxic else 0.1)
        words = draw.choices(plain, k=draw.randint(5, 40)) + draw.sample(rude, 2) * toxic + ["you"] * insult
        draw.shuffle(words)
        rows.append((" ".join(words), int(insult), int(toxic)))
    return rows


def test_probabilities_match_a_plain_chain_and_held_out_rows_are_judged_right(spark):
    rows = corpus(8, 500)
    texts = [t for t, _, _ in rows] + [None, "", "vile nasty you", " word1 word2" * 60_000]
    labelled = list(range(300))
    expected = plain_chain(texts, labelled, [rows[i][1:] for i in labelled])
    documents = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, p_insult double")
    # Labels of another integer type, one of them twice.
    labels = spark.createDataFrame([(i, *rows[i][1:]) for i in [*labelled, 7]], "doc_id int, insult int, toxic int")
    found = {r.doc_id: r for r in toxicity(documents.repartition(5), labels, ("insult", "toxic")).collect()}
    assert sorted(found) == list(range(len(texts)))
    for i, (insult, toxic) in enumerate(expected):
        assert abs(found[i].p_insult - insult) < 1e-6 and abs(found[i].p_toxic - toxic) < 1e-6
        assert found[i].rejected == (toxic >= 0.6)
    held_out = range(300, 500)
    assert sum(found[i].rejected == bool(rows[i][2]) for i in held_out) >= 0.98 * len(held_out)
    assert found[502].rejected and not found[503].rejected


def test_later_models_see_earlier_categories(spark):
    """Without the first category's probability the second one's differs."""
    rows = corpus(9, 200)
    documents = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id long, insult int, toxic int")
    chained = {r.doc_id: r.p_toxic for r in toxicity(documents, labels, ("insult", "toxic")).collect()}
    alone = {r.doc_id: r.p_toxic for r in toxicity(documents, labels, ("toxic",)).collect()}
    assert max(abs(chained[i] - alone[i]) for i in alone) > 1e-4
