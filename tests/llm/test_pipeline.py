"""The pipeline against a brute-force version of its five stages."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import xxhash

import corpus_pipeline
from hiatus.llm.toxicity import FEATURES, FOLDS, THRESHOLD, Features, fit_chain

SOURCES = ("web", "books", "code", None)
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def tables() -> tuple[list, list, list]:
    """Documents, labels and benchmark with a case of every kind planted."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdeghiklmnoprstuéü", k=draw.randint(3, 9))) for _ in range(900)]

    def prose(count: int) -> str:
        return " ".join(draw.choices(vocabulary, k=count))

    passage, accents = prose(70), "é" * 190
    items = [prose(14), prose(11), "three short words", None, ""]
    texts = [prose(draw.randint(40, 160)) for _ in range(150)]
    texts += [f"{prose(30)} vile filth {prose(20)} nasty scum" for _ in range(60)]
    texts += texts[:8] + [t + " changed" for t in texts[8:40]] + [texts[3]] * 5
    texts += [f"{prose(50)} {passage} {prose(50)}" for _ in range(6)]
    # the shared bytes begin and end inside characters, whose halves would make another one
    texts += [f"{prose(60)} {head}{accents}{tail} {prose(60)}" for head, tail in ("aè", "bé", "cñ", "dü")]
    texts += [f"{prose(60)} x{a}{passage}{b}y {prose(60)}" for a, b in (("©", "é"), ("é", "è"), ("ũ", "ê"))]
    texts += [f"{prose(20)}, {re.sub("[a-z]", lambda m: m[0].upper(), items[0])}! {prose(20)}", f"{prose(9)} three, short words {prose(9)}"]
    texts += [" ".join(items[1].split()[:9]) + " " + prose(30), prose(3), "x", "", None, " \t", None]
    documents = [
        (i, t, "en", SOURCES[0 if i % 3 else i % 4], None if t is None else len(t)) for i, t in enumerate(texts)
    ]
    labels = [(i, int(i % 5 > 0), int(150 <= i < 210)) for i in range(0, 210) if i % 7]
    return documents, labels, list(enumerate(items))


def not_toxic(documents: list, labels: list) -> list:
    label_of = {i: (1 - quality, toxic) for i, quality, toxic in labels}
    contents = [(i, (t or "").encode()) for i, t, *_ in documents]
    fitted = [(text, label_of[i]) for i, text in contents if i in label_of]
    features = Features()
    chain = fit_chain(
        [features.of(text) for text, _ in fitted],
        np.array([xxhash.xxh32_intdigest(text, 3) % FOLDS for text, _ in fitted]),
        np.array([target for _, target in fitted]),
    )

    def probability(text: bytes) -> float:
        earlier: list[float] = []
        for weights in chain:
            margin = sum(weights[place] for place in features.of(text).tolist()) + weights[-1]
            margin += sum(p * weights[FEATURES + k] for k, p in enumerate(earlier))
            earlier.append(1 / (1 + math.exp(-min(30, max(-30, margin)))))
        return earlier[-1]

    return [d for d, (_, text) in zip(documents, contents) if probability(text) < THRESHOLD]


def simhash(text: bytes) -> int:
    words = [w for w in re.split(rb"[ \t-\r]+", text.lower()) if w]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def first_of_component(documents: list) -> list:
    prints = [simhash((d[1] or "").encode()) for d in documents]
    root = list(range(len(documents)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(documents)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [d for i, d in enumerate(documents) if find(i) == i]


def without_repeats(documents: list, length: int = 200) -> list:
    contents = [(d[1] or "").encode() for d in documents]
    seen = Counter(c[i : i + length] for c in contents for i in range(len(c) - length + 1))
    out = []
    for (ident, text, lang, source, n_chars), content in zip(documents, contents):
        covered = bytearray(len(content))
        for i in range(len(content) - length + 1):
            if seen[content[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        if any(covered):  # a character stays if no byte of it is covered
            ends = np.cumsum([len(c.encode()) for c in text])
            text = "".join(c for c, end in zip(text, ends) if not any(covered[end - len(c.encode()) : end]))
            n_chars = len(text)
        out.append((ident, text, lang, source, n_chars))
    return out


def word_list(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def not_leaked(documents: list, items: list) -> list:
    found = [word_list(text) for _, text in items]
    windows = {tuple(w[i : i + 10]) for w in found if w for i in range(max(1, len(w) - 9))}

    def leaks(words: list[bytes]) -> bool:
        return any(tuple(words[i : i + len(w)]) == w for w in windows for i in range(len(words) - len(w) + 1))

    return [d for d in documents if not leaks(word_list(d[1]))]


def mixture(documents: list) -> list:
    size: Counter = Counter()
    for d in documents:
        size[d[3]] += len((d[1] or "").encode())
    rate = {s: sum(size.values()) / sum(n > 0 for n in size.values()) / n if n else 1.0 for s, n in size.items()}
    out = []
    for d in documents:
        name = f"{d[0]}|{hashlib.md5((d[1] or '').encode()).hexdigest()}|0"  # ids don't repeat here
        unit = (int(hashlib.md5(f"17|{name}|0".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        copies, p = 0, math.exp(-rate[d[3]])
        total = p
        while total < unit:
            copies += 1
            p *= rate[d[3]] / copies
            total += p
        out += [(*d, k, hashlib.md5(f"17|order|{name}|{k}".encode()).hexdigest()) for k in range(copies)]
    return out


def test_pipeline_equals_brute_force(spark, tmp_path):
    documents, labels, items = tables()
    spark.createDataFrame(documents, COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    clean = not_toxic(documents, labels)
    assert len(documents) - len(clean) >= 55  # of 60 planted
    unique = first_of_component(clean)
    assert len(unique) < len(clean) - 12  # exact copies at least
    cut = without_repeats(unique)
    assert sum(a[1] != b[1] for a, b in zip(unique, cut)) >= 10
    kept = not_leaked(cut, items)
    assert len(cut) - len(kept) == 2
    expected = mixture(kept)

    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy", "mix_key"]
    assert Counter(map(tuple, found.collect())) == Counter(expected)


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
