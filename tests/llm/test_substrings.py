from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from mailrisk.llm import substrings
from mailrisk.llm.substrings import Repeats


def corpus(seed=7):
    chance = random.Random(seed)
    words = ["the", "of", "a", "Ü", *(f"w{at}" for at in range(300))]
    passages = [chance.choices(words, k=size) for size in (50, 51, 49, 80, 200)]
    rows = []
    for doc_id in range(80):
        text = chance.choices(words, k=chance.randint(0, 150))
        for passage in chance.sample(passages, chance.choice([0, 0, 1, 2])):
            at = chance.randint(0, len(text))
            text[at:at] = passage
        rows.append((doc_id, chance.choice([" ", "\n", " \t "]).join(text)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, " ".join(passages[4])), (103, "z " * 500), (104, "z " * 49), (105, ""), (106, None)]
    chance.shuffle(rows)
    return rows


def cut(spark, rows, rule=Repeats(), schema="doc_id long, text string"):
    return substrings.cut_documents(spark.createDataFrame(rows, schema), rule).collect()


@pytest.mark.parametrize("rule", [Repeats(), Repeats(words=12, run=3), Repeats(run=1), Repeats(most_bits=16, cells_per_anchor=1, rows=1)])
def test_against_plain_version(spark, rule):
    rows = corpus()
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in cut(spark, rows, rule)}
    assert found == brute.cut_repeats(rows, rule.words)


def test_texts_that_are_left(spark):
    shared = [f"s{at}" for at in range(60)]
    rows = [(2, " ".join(["x", *shared, "y"])), (1, " ".join(shared)), (9, " ".join(shared))]
    left = {r.doc_id: r.left for r in cut(spark, rows)}
    assert left == {1: None, 2: "x y", 9: ""}


def test_special_rows(spark):
    text = " ".join(f"t{at}" for at in range(70))
    rows = [(1, text, "a"), (1, text, "b"), (1, text + " more", "c"), (None, text, "d"), (None, text, "e"), (4, "q " + text, "f")]
    found = sorted(((r.doc_id, r.n_removed) for r in cut(spark, rows, schema="doc_id long, text string, places string")), key=str)
    assert found == sorted([(1, 0), (1, 0), (1, 0), (None, 0), (None, 0), (4, 70)], key=str)
    assert cut(spark, []) == []


def test_runs_cover_every_window():
    values = np.repeat(np.array([5, 9, 5, 7], np.uint64), [1, 10, 3, 64])
    starts, sizes = substrings._runs(values, Repeats(run=4))
    assert sizes.max() == 4 and np.array_equal(np.concatenate([np.arange(a, a + n) for a, n in zip(starts, sizes)]), np.arange(78))
    assert all(len(set(values[a : a + n])) == 1 for a, n in zip(starts, sizes))
    assert [len(part) for part in substrings._runs(values[:0], Repeats())] == [0, 0]


def test_equal_windows_have_equal_anchors_and_sketches_lose_none(spark):
    chance = np.random.default_rng(1)
    window = chance.integers(0, 2**63, 50, dtype=np.uint64)
    seen = {int(substrings.anchors(np.concatenate([chance.integers(0, 2**63, n, dtype=np.uint64), window, window[:n]]), 50)[n]) for n in (0, 1, 30)}
    assert len(seen) == 1
    values = chance.integers(0, 2**63, 40, dtype=np.uint64)
    assert np.array_equal(substrings.sliding_minimum(values, 26), [values[at : at + 26].min() for at in range(15)])
    documents = spark.createDataFrame(corpus(), "doc_id long, text string")
    bits, filled = substrings.sketch(documents, Repeats())
    rows = [(row.doc_id, (row.text or "").encode()) for row in documents.collect()]
    anchors_of = [set(substrings.anchors(hashes, 50).tolist()) for _, hashes in substrings._documents([text for _, text in rows])]
    counts = {}
    for own in anchors_of:
        for anchor in own:
            counts[anchor] = counts.get(anchor, 0) + 1
    repeated = np.array([anchor for anchor, n in counts.items() if n > 1], np.uint64)
    assert len(repeated) and substrings._passes(repeated, bits, filled).all()
