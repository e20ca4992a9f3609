"""Token counts against the library."""

from __future__ import annotations

import random
import sys

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hiatus.llm.token_counts import Merges, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def merges():
    return Merges(PATH)


def by_library(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    assert Merges_.count(text) == by_library(Library_, text)


Merges_, Library_ = Merges(PATH), Tokenizer.from_file(PATH)


def test_every_character(library, merges):
    """All code points but surrogates, each between letters, digits and spaces."""
    wrong = []
    for code in range(sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000 or (code > 0x3400 and code % 37):
            continue
        text = f"a{chr(code)}b {chr(code)}1 {chr(code)} {chr(code)}"
        if merges.count(text) != by_library(library, text):
            wrong.append(hex(code))
    assert wrong == []


def test_prose_specials_and_long_pieces(library, merges):
    rng = random.Random(4)
    texts = [
        "It's they'll WE'VE 12345 ...!!!   \n\n  end  ",
        "a<|endoftext|>b<|endoftext|><|endoftext|> c <|endoftext",
        "".join(rng.choice("abcdefghij") for _ in range(20_000)),
        "a" * 5000,
        " " * 3000 + "x" + "\t" * 50,
        "é" * 999 + "語" * 999,
    ]
    assert [merges.count(t) for t in texts] == [by_library(library, t) for t in texts]


def test_operator(spark, library):
    frame = spark.createDataFrame(
        [(1, None, 5), (2, "", 6), (2, "héllo " * 400, 7), (None, "x", 8)], "doc_id long, text string, n_tokens int"
    )
    rows = sorted(map(tuple, token_counts(frame, PATH).drop("text").collect()), key=repr)
    assert rows == sorted(
        [
            (i, len((t or "").encode()), by_library(library, t or ""), by_library(library, t or "") > 512)
            for i, t, _ in frame.collect()
        ],
        key=repr,
    )
    assert token_counts(frame.limit(0), PATH).count() == 0
