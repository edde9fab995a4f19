from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mailrisk.llm import tokens

FILE = public_tokenizers.path("word_bpe_49k.json")
PARTS = list("abcXYZ019 \n\t\x0b\x00\x1c\x85\xa0'’\"!?.,-_éÉßİıΣςσＡ中文字한́å Åﬁ½²٣🙂‍ 　﻿ẞ") + [
    "<|startoftext|>", "<|endoftext|>", "'s", "'re", "'LL", "<|start", " the ", "of",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(FILE)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def whole():
    with open(FILE, encoding="utf-8") as file:
        definition = file.read()
    return definition, tokens.whole_tokens(definition)


def test_counts_equal_the_library(library, whole):
    counter = tokens.PreTokenCounter(*whole)
    chance = random.Random(5)
    for _ in range(4000):
        text = "".join(chance.choices(PARTS, k=chance.randint(0, 40)))
        assert counter.count(text) == library(text), repr(text)
    for _ in range(500):
        text = "".join(chr(chance.choice([chance.randint(1, 0x2FF), chance.randint(0xE000, 0x1FFFF)])) for _ in range(20))
        assert counter.count(text) == library(text), repr(text)


def test_whole_tokens_are_proven_one_by_one(library, whole):
    assert len(whole[1]) > 30_000 and "the" in whole[1]
    for word in random.Random(1).sample(sorted(whole[1]), 500):
        assert library(word) == 1


def test_long_texts_are_cut_safely(library, whole, monkeypatch):
    monkeypatch.setattr(tokens, "_PIECE", 50)
    counter = tokens.PreTokenCounter(*whole)
    text = "It's a <|endoftext|> <|startoftext|>test of ünïcode'll words\n" * 60 + "x" * 500
    assert counter.count(text) == library(text)


def test_memory_of_counts_is_bounded(library, whole, monkeypatch):
    monkeypatch.setattr(tokens, "_MOST_KEPT", 10)
    counter = tokens.PreTokenCounter(*whole)
    text = " ".join(f"zq{at}xv" for at in range(200))
    assert counter.count(text) == library(text) and len(counter._words) < len(whole[1]) + 20


def test_rows_of_every_kind(spark, library):
    rows = [(1, "one two", "a", 5), (1, "one two", "a", 5), (None, None, None, None), (2, "", "b", 1), (3, "é " * 3000, "c", 2)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string, _text long")
    result = tokens.count_tokens(documents.drop("_text"), FILE).collect()
    assert sorted((str(r.doc_id), str(r.n_bytes), *r.tokens) for r in result) == sorted(
        (str(i), str(extra), len((t or "").encode()), library(t), library(t) > 2048) for i, t, extra, _ in rows
    )
    assert tokens.count_tokens(documents.limit(0), FILE).collect() == []
