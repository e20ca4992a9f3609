"""Lattice likelihoods and word scores against brute force."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from hiatus.llm import language_model
from hiatus.llm.language_model import Lattice, score_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(text, pieces, octets):
    """The summed probability of every way to cut a text."""
    if not text:
        return 1.0
    total = 0.0
    for end in range(1, len(text) + 1):
        if text[:end] in pieces:
            total += math.exp(pieces[text[:end]]) * all_segmentations(text[end:], pieces, octets)
    spelt = math.prod(math.exp(octets[b]) for b in text[0].encode())
    return total + spelt * all_segmentations(text[1:], pieces, octets)


def test_forward_recursion_sums_all_segmentations():
    pieces = {"▁": -1.0, "▁a": -2.0, "a": -1.5, "ab": -2.5, "b": -1.2, "ba": -3.0, "aba": -0.7, "▁ab": -4.0}
    octets = [-5.0 - b / 100 for b in range(256)]
    lattice = Lattice(pieces, octets)
    for word in ["a", "ab", "abab", "babab", "aé", "zz", "abcab"]:
        expected = math.log10(all_segmentations("▁" + word, pieces, octets))
        assert lattice.log10(word.encode()) == pytest.approx(expected, rel=1e-12)


def test_probabilities_of_short_words_stay_below_one():
    lattice = Lattice({"▁": math.log(0.5), "a": math.log(0.25)}, [math.log(0.25 / 256)] * 256)
    assert sum(10 ** lattice.log10(w.encode()) for w in ["", "a", "aa", "aaa"]) < 1


def expected(rows):
    """Base scores, counts and lattice scores by the definitions."""
    def words(text):
        return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
                for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]

    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter()
    for (_, text), h in zip(rows, held):
        if not h:
            counts.update(words(text) + [" end"])
    n, v = sum(counts.values()), len(counts)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = Counter()
    for w, c in counts.items():
        if w != " end":
            for p in model.encode(w):
                pieces[p] += c
    usable = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    whole = sum(pieces[i] + 1 for i in usable) + counts[" end"] + 1
    weights = {model.id_to_piece(i): math.log((pieces[i] + 1) / whole) for i in usable if not model.is_byte(i)}
    octets = [math.log((pieces[model.piece_to_id(f"<0x{b:02X}>")] + 1) / whole) for b in range(256)]
    lattice = Lattice(weights, octets)
    end = math.log10((counts[" end"] + 1) / whole)
    out = []
    for (i, text), h in zip(rows, held):
        ws = words(text) + [" end"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        score = sum(lattice.log10(w.encode()) for w in ws[:-1]) + end
        out.append((i, h, len(ws), sum(counts[w] > 0 for w in ws), n, base, score))
    return out


ROWS = [
    (i, " ".join(f"{'Wort' if i % 3 else 'word'}{i * k % 17} The\tthe É{k}" for k in range(i % 9)))
    for i in range(60)
] + [(None, "the null id"), (7, None), (7, ""), (8, "never\x00seen 語"), (8, "never\x00seen 語")]


@pytest.mark.parametrize("head", [1 << 16, 3])
def test_scores_match_the_definitions(spark, monkeypatch, head):
    """Also with nearly all words joined by shuffle."""
    monkeypatch.setattr(language_model, "HEAD_WORDS", head)
    frame = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, score string").repartition(3)
    found = sorted((tuple(r) for r in score_texts(frame, PATH).collect()), key=lambda r: (str(r[0]), r[2], r[6]))
    wanted = sorted(expected(ROWS), key=lambda r: (str(r[0]), r[2], r[6]))
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    for a, b in zip(found, wanted):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_held_out_texts_prefer_seen_words(spark):
    """Real words score better than the same letters shuffled."""
    frame = spark.createDataFrame(
        [(i, "the old house stands near the river and the hill") for i in range(40)]
        + [(100, "the old house"), (101, "hte dlo suohe")],
        "doc_id long, text string",
    )
    scores = {r.doc_id: r.score for r in score_texts(frame, PATH).collect()}
    assert scores[100] > scores[101]


def test_empty_table(spark):
    assert score_texts(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
