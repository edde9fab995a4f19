from __future__ import annotations

import itertools
import random

import brute
import numpy as np
import pytest

from mailrisk.llm import repair
from mailrisk.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired(spark, rows, schema=SCHEMA):
    turns, report = repair.repair_conversations(spark.createDataFrame(rows, schema))
    found = report.join(repair.digests(turns), "conv", "left").collect()
    empty = brute.sha("")
    return {int(r.conv[1:]) if r.conv else None: tuple((r[name] if r[name] is not None else empty) for name in NAMES) for r in found}


def some_rows(chance, conv_id, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", ""]
    texts = ["Yes.", "no", "Why? ", " ", "", "same.", "same.", "more!"]
    return [
        (conv_id, None if chance.random() < 0.05 else chance.randint(0, n), chance.choice(roles), f"{chance.choice(['', '', at])}{chance.choice(texts)}")
        for at in range(n)
    ]


def test_against_plain_version(spark):
    chance = random.Random(1)
    rows = [row for conv_id in range(150) for row in some_rows(chance, conv_id, chance.randint(1, 14))]
    chance.shuffle(rows)
    assert repaired(spark, rows) == brute.repaired_turns(rows)


def test_long_conversations_in_small_pieces(spark, monkeypatch):
    chance = random.Random(2)
    rows = some_rows(chance, 1, 600) + some_rows(chance, None, 250) + some_rows(chance, 2, 3) + [(4, at, "user", "ok.") for at in range(40)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(repair, "_LEVELS", (2, 4, 33, 34, 63))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = repaired(spark, rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found == brute.repaired_turns(rows)


def test_ranks_order_nodes_by_their_audits():
    chance = np.random.default_rng(3)
    lengths = np.array([5, 1, 9])
    codes = chance.integers(0, 16, lengths.sum()).astype(np.uint8)
    goals = np.repeat(repair._END_COSTS[None, None], 3, axis=0)
    _, ranks, pointers, letters, _ = repair.ranked_paths(codes, lengths, goals, np.full(3, True))

    def audit(node):
        said = ""
        while letters[node]:
            said, node = said + repair.EDITS[letters[node] - 1], pointers[0][node]
        return said

    audits = [audit(node) for node in range(ranks.size)]
    for (one, first), (two, second) in itertools.combinations(enumerate(ranks.ravel()), 2):
        assert (audits[one] < audits[two]) == (first < second) and (audits[one] == audits[two]) == (first == second)
    nodes, path = repair.walk(np.arange(ranks.size), pointers, letters)
    for start in range(ranks.size):
        assert "".join(repair.EDITS[letters[node] - 1] for node in nodes[path == start]) == audits[start]


def test_sums_of_pieces_are_associative():
    chance = np.random.default_rng(4)
    ends = np.full((4, 4), repair._NEVER)
    np.fill_diagonal(ends, 0)
    parts = [chance.integers(0, 16, n).astype(np.uint8) for n in (3, 1, 4)]

    def summed(codes):
        costs, ranks, *_ = repair.ranked_paths(codes, np.array([len(codes)]), ends[None], np.array([False]))
        return costs[0], ranks[0].T

    whole = summed(np.concatenate(parts))
    one, two, three = map(summed, parts)
    for found in (repair.join_sums(repair.join_sums(one, two), three), repair.join_sums(one, repair.join_sums(two, three))):
        assert (found[0] == whole[0]).all()
        for state in range(4):
            reached = whole[0][state] < repair._NEVER
            assert (np.argsort(found[1][state][reached]) == np.argsort(whole[1][state][reached])).all()


def test_special_rows(spark):
    long_text = "word " * 100_000
    rows = [
        (None, None, None, None, 1), (None, None, "user", "Hi.", 1), (1, 2, "user", long_text, 1), (1, 2, "user", long_text, 1),
        (2, 5, "assistant", "x!", 1), (3, 9, "ass\nistant", "ü.\t", 1),
    ]
    plain = [(conv_id, turn, role or " ", text or " ") for conv_id, turn, role, text, _ in rows]
    assert repaired(spark, rows, SCHEMA + ", _place int") == brute.repaired_turns(plain)
    assert repaired(spark, []) == {}


def test_query(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = brute.repaired_turns(brute.damaged_rows(given))
    for conv_id in {row[0] for row in given} - set(expected):
        expected[conv_id] = (0, 0, 0, 0, 0, 0, "", brute.sha(""))
    found = {r.conv_id: tuple(r[name] for name in NAMES) for r in QUERIES["op11_repaired_turns"](spark, SF_DIR).collect()}
    assert found == expected


@pytest.mark.parametrize("turn", [None, 3])
def test_damage(spark, turn):
    given = [(conv_id, turn, None if conv_id % 3 else "assistant", None if conv_id % 2 else "A. b!") for conv_id in range(60)]
    found = repair.damaged(spark.createDataFrame(given, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute.damaged_rows(given), key=str)
