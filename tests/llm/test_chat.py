from __future__ import annotations

import brute
import pytest
from pyspark.sql import functions as F

from mailrisk.llm import chat

CONTROL = "</s>[INST] ok [/INST] <|im_end|> ~1 ~ <<SYS>> < [ <s>"
TREE = "tree long, message long, parent long, role string, text string, score double"


def read_back(spark, paths):
    formatted = chat.format_paths(paths)
    return {
        (row.tree, row.leaf): row
        for row in formatted.select(
            "tree", "leaf", "rank", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
            chat.masked_text(F.col("formatted"), F.col("mask")).alias("loss"),
        ).collect()
    }


def test_round_trip_of_control_strings(spark):
    rows = [(1, 0, "us\ner", CONTROL), (1, 1, "assistant", CONTROL + "é🙂"), (1, 2, None, None), (1, 3, "assistant", "last\n")]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    row = read_back(spark, chat.best_paths(chat.chains(conversations)))[(1, 4)]
    assert [tuple(turn) for turn in row.turns] == [("us\ner", CONTROL), ("assistant", CONTROL + "é🙂"), ("", ""), ("assistant", "last\n")]
    assert row.loss == CONTROL + "é🙂last\n"
    assert "[INST]" not in row.formatted and "</s>" not in row.formatted and row.formatted.count(chat.END) == 4


def walk(messages):
    parents = {key: parent for (key, parent, _) in messages}
    scores = {key: score or 0.0 for (key, _, score) in messages}
    leaves = set(parents) - set(parents.values())
    paths = {}
    for leaf in leaves:
        path, at = [], leaf
        while at is not None:
            path.append(at)
            at = parents[at] if parents[at] in parents else None
        paths[leaf] = path[::-1]
    ranked = sorted(leaves, key=lambda leaf: (-sum(scores[m] for m in paths[leaf]) / len(paths[leaf]), -len(paths[leaf]), leaf))
    return [(leaf, paths[leaf]) for leaf in ranked]


def test_branches_are_ranked_and_expanded(spark):
    messages = [(0, None, 1.0), (1, 0, 0.5), (2, 0, 0.9), (3, 1, 0.8), (4, 2, None), (5, 4, 3.0), (6, 4, 3.0), (7, 99, 0.1)]
    messages += [(10 + at, 9 + at if at else 3, 0.7) for at in range(37)]
    rows = [(tree, key, parent, "user", f"m{key}", score) for tree in (1, None) for key, parent, score in messages]
    paths = chat.best_paths(spark.createDataFrame(rows + rows[:3], TREE), branches=3)
    found = read_back(spark, paths)
    for tree in (1, None):
        for rank, (leaf, path) in enumerate(walk(messages)[:3], 1):
            row = found[(tree, leaf)]
            assert row["rank"] == rank and [turn.text for turn in row.turns] == [f"m{key}" for key in path]
    assert len(found) == 6


def test_cycles_empty_tables_and_long_chains(spark):
    cycle = spark.createDataFrame([(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0)], TREE)
    with pytest.raises(ValueError, match="cycle"):
        chat.best_paths(cycle)
    assert chat.format_paths(chat.best_paths(spark.createDataFrame([], TREE))).collect() == []
    long = [(5, at, "assistant" if at % 2 else "user", f"t{at} " * 40) for at in range(700)]
    conversations = spark.createDataFrame(long, "conv_id long, turn long, role string, text string")
    row = read_back(spark, chat.best_paths(chat.chains(conversations)))[(5, 700)]
    assert brute.sha(row.loss) == brute.sha("".join(text for _, _, role, text in long if role == "assistant"))
    assert [turn.text for turn in row.turns] == [text for *_, text in long]


def test_tied_turns_go_by_role_and_text(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, None, "user", "first")]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    row = read_back(spark, chat.best_paths(chat.chains(conversations)))[(1, 4)]
    assert [turn.text for turn in row.turns] == ["first", "a", "a", "b"]
