from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from mailrisk.llm import simhash
from mailrisk.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def grouped(spark, rows, words=3, distance=2, schema="doc_id long, text string"):
    rule = simhash.Fingerprinting(words=words, distance=distance)
    found = simhash.group_documents(spark.createDataFrame(rows, schema), rule).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str)


def edited_copies(seed=3):
    chance = random.Random(seed)
    words = [f"W{at}é" for at in range(500)]
    rows = []
    for size in (1, 2, 6, 60):
        base = chance.choices(words, k=400)
        for _ in range(size):
            text = list(base)
            for _ in range(chance.randint(0, 3)):
                text[chance.randrange(len(text))] = chance.choice(words)
            rows.append((1000 - len(rows), " \n".join(text)))
    return rows


def test_against_all_pairs(spark):
    rows = edited_copies()
    expected = brute.simhash_groups(rows, 3, 2)
    assert len({one for _, _, one in expected}) < len(rows)
    assert grouped(spark, rows) == expected


def test_small_units_are_walked_further_down(spark, monkeypatch):
    monkeypatch.setattr(simhash, "_NODE_KEYS", 8)
    monkeypatch.setattr(simhash, "_UNIT_ROWS", 6)
    rows = edited_copies(5)
    assert grouped(spark, rows) == brute.simhash_groups(rows, 3, 2)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_walk_finds_every_close_pair_once(distance, monkeypatch):
    monkeypatch.setattr(simhash, "_SOME_PAIRS", 50)
    chance = np.random.default_rng(distance)
    base = chance.integers(0, 2**63, 30, dtype=np.uint64)
    keys = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << chance.integers(0, 64, 30).astype(np.uint64)) for _ in range(12))]))
    expected = {(i, j) for j in range(len(keys)) for i in range(j) if (int(keys[i]) ^ int(keys[j])).bit_count() <= distance}
    found = [pair for i, j in simhash.close_pairs(keys, keys, 0, distance, True) for pair in zip(i.tolist(), j.tolist())]
    assert len(found) == len(set(found)) and set(found) == expected


def test_spanning_joins_all_that_is_linked():
    links = [(np.array([5, 1, 7]), np.array([6, 2, 8])), (np.array([6, 2]), np.array([7, 3]))]
    assert simhash.spanning(10, iter(links)).tolist() == [0, 1, 1, 1, 4, 5, 5, 5, 5, 9]


def test_special_rows(spark):
    long_text = "a b c " * 60_000
    rows = [
        (4, None, "x"), (9, "", "y"), (7, " \n ", "z"), (None, "one two", "k"), (None, "ONE  two", "k"), (3, "One two", "k"),
        (3, "One two", "k"), (11, long_text, "k"), (None, "alone here now", "k"),
    ]
    expected = brute.simhash_groups([(r[0], r[1]) for r in rows], 3, 2)
    found = grouped(spark, rows, schema="doc_id long, text string, key string")
    assert found == expected and (9, "0" * 16, 4) in found
    assert grouped(spark, []) == []


def test_query(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = sorted((tuple(r) for r in QUERIES["op12_trie_join"](spark, SF_DIR).collect()), key=str)
    assert found == brute.simhash_groups([tuple(r) for r in documents], 3, 2)
