from __future__ import annotations

import random

import brute
import numpy as np

from mailrisk.llm import minhash
from mailrisk.llm.components import components


def near_copies(seed=11):
    chance = random.Random(seed)
    words = [f"w{at}" for at in range(900)]
    rows, next_id = [], 0
    for size in (1, 1, 2, 5, 30):
        base = chance.choices(words, k=120)
        for _ in range(size):
            text = list(base)
            for _ in range(chance.randint(0, 7)):
                text[chance.randrange(len(text))] = chance.choice(words)
            rows.append((next_id, " ".join(text)))
            next_id += 1
    chain = chance.choices(words, k=100)  # each like the next one only
    for _ in range(12):
        rows.append((next_id, " ".join(chain)))
        next_id += 1
        for _ in range(4):
            chain[chance.randrange(len(chain))] = chance.choice(words)
    passage = chance.choices(words, k=60)  # half of each text, below the limit
    for _ in range(15):
        rows.append((next_id, " ".join(passage + chance.choices(words, k=60))))
        next_id += 1
    rows += [(next_id, "A b"), (next_id + 1, "a  B\n"), (next_id + 2, "É b"), (next_id + 3, "é b"), (next_id + 4, ""), (next_id + 5, None)]
    chance.shuffle(rows)
    return rows


def grouped(spark, rows, words=4, schema="doc_id long, text string"):
    result = minhash.group_documents(spark.createDataFrame(rows, schema), minhash.Similarity(words=words))
    return result.collect()


def test_against_all_pairs(spark):
    rows = near_copies()
    for words in (4, 5):
        found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in grouped(spark, rows, words)}
        assert found == brute.near_groups(rows, words)


def test_a_bucket_of_edited_copies_does_not_become_all_pairs(spark, monkeypatch):
    chance = random.Random(8)
    base = [f"b{at}" for at in range(200)]
    rows = []
    for doc_id in range(500):
        text = list(base)
        for _ in range(chance.randint(1, 11)):
            text[chance.randrange(len(text))] = f"n{chance.randrange(10**6)}"
        rows.append((doc_id, " ".join(text)))
    joined = []
    possible = minhash._possible

    def counted(grouped, rule):
        pairs = possible(grouped, rule)
        joined.append(pairs.count())
        return pairs

    monkeypatch.setattr(minhash, "_possible", counted)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in grouped(spark, rows, 5)}
    assert found == brute.near_groups(rows, 5)
    assert len(joined) == 1 and joined[0] <= 20 * len(rows)


def test_signatures_equal_the_definition_and_estimate_similarity():
    chance = np.random.default_rng(4)
    registers = 16
    sets = [chance.integers(0, 2**63, size, dtype=np.uint64) for size in (1, 2, 40, 300)]
    signed = minhash.super_minhash(sets, registers)
    for elements, signature in zip(sets, signed):
        expected = [2**64 - 1] * registers
        for element in elements:
            order = list(range(registers))
            for rank in range(registers):
                seed = np.array([element], np.uint64) + np.uint64((rank + 1) * minhash._GOLDEN & 0xFFFFFFFFFFFFFFFF)
                draw = int(minhash.mix(seed)[0])
                swap = rank + ((draw & 0xFFFFFFFF) * (registers - rank) >> 32)
                order[rank], order[swap] = order[swap], order[rank]
                expected[order[rank]] = min(expected[order[rank]], rank << 32 | draw >> 32)
        assert signature.tolist() == expected
    common, own = chance.integers(0, 2**63, (60, 80), dtype=np.uint64), chance.integers(0, 2**63, (60, 2, 10), dtype=np.uint64)
    left = minhash.super_minhash([np.concatenate([c, o[0]]) for c, o in zip(common, own)], 112)
    right = minhash.super_minhash([np.concatenate([c, o[1]]) for c, o in zip(common, own)], 112)
    assert abs((left == right).mean() - 0.8) < 0.02


def test_special_rows(spark):
    text = " ".join(f"t{at}" for at in range(40))
    rows = [(5, text, "x"), (3, text, "y"), (3, text, "y"), (None, text, "z"), (None, "only here", "z"), (7, None, None), (None, None, None)]
    found = grouped(spark, rows, schema="doc_id long, text string, digest string")
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str) == sorted(
        [(5, 37, 3, False), (3, 37, 3, True), (3, 37, 3, True), (None, 37, 3, False), (None, 1, None, True), (7, 0, 7, True), (None, 0, None, True)],
        key=str,
    )
    documents = spark.createDataFrame(rows, "doc_id long, text string, _rows string")
    kept = minhash.keep_one(documents)
    assert kept.columns == documents.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, text), (None, "only here"), (7, None), (None, None)], key=str
    )
    assert grouped(spark, []) == [] and minhash.keep_one(documents.limit(0)).collect() == []


def test_components_of_paths_stars_and_rings(spark):
    chance = random.Random(2)
    pairs = [(at + 1, at) for at in range(64)] + [(200, at) for at in range(100, 130)] + [(300 + (at + 1) % 20, 300 + at) for at in range(20)]
    pairs = [(max(p), min(p)) for p in pairs] * 2
    chance.shuffle(pairs)
    found = {r.node: r.low for r in components(spark.createDataFrame(pairs, "node long, low long")).collect()}
    expected = {at: 0 for at in range(1, 65)} | {at: 100 for at in (*range(101, 130), 200)} | {at: 300 for at in range(301, 320)}
    assert found == expected
    assert components(spark.createDataFrame([], "node long, low long")).collect() == []
