from __future__ import annotations

import random

import brute
import pytest

from mailrisk.llm import contamination
from mailrisk.llm.contamination import Overlap

ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string"


def corpus(seed=9):
    chance = random.Random(seed)
    words = ["the", "of", "and", *(f"w{at}" for at in range(40))]
    items = [(at, " ".join(chance.choices(words, k=chance.choice([9, 10, 11, 25, 40])))) for at in range(25)]
    items += [(50, "Rare"), (51, "two Words"), (52, "the of the of the of the of the of the of the"), (53, ""), (54, None), (None, "null item has words here"), (55, items[0][1]), (56, "!!! --")]
    rows = []
    for doc_id in range(60):
        text = chance.choices(words, k=chance.randint(0, 90))
        if chance.random() < 0.5:
            own = chance.choice(items)[1] or ""
            at = chance.randint(0, len(text))
            piece = own.split()
            start = chance.randint(0, max(len(piece) - 12, 0))
            text[at:at] = piece[start:]
        rows.append((doc_id, chance.choice([" ", "-", ", ", "\n"]).join(text).upper() if doc_id % 2 else " ".join(text)))
    rows += [(100, "rare"), (101, "x TWO,words rare"), (102, "the of " * 40), (103, None), (104, ""), (105, "null item HAS words here")]
    return rows, items


@pytest.mark.parametrize("rule", [Overlap(), Overlap(most_broadcast=0), Overlap(window=4, shingle=3)])
def test_against_plain_version(spark, rule):
    rows, items = corpus()
    judged = contamination.judge_documents(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS), rule)
    found = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in judged.collect()}
    assert found == brute.contaminated(rows, items, rule.window)
    clean = contamination.clean_documents(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS), rule)
    assert {r.doc_id for r in clean.collect()} == {doc_id for doc_id, (_, hit, _) in found.items() if not hit}


def test_special_rows(spark):
    item = " ".join(f"i{at}" for at in range(12))
    long = "x " * 50_000 + item + " y"
    rows = [(1, long, "a", 3), (1, long, "b", 4), (None, item, "c", 5), (None, None, None, None), (2, item[:-4], "d", 6)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, `at` string, copy long")
    items = spark.createDataFrame([(7, item, "x"), (7, item, "y")], "item_id long, text string, words string")
    found = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in contamination.judge_documents(documents, items).collect()), key=str)
    assert found == sorted([(1, 50_013, 12, ["7"]), (1, 50_013, 12, ["7"]), (None, 12, 12, ["7"]), (None, 0, 0, []), (2, 11, 11, ["7"])], key=str)
    assert contamination.clean_documents(documents, items).columns == documents.columns


def test_empty_tables(spark):
    documents, items = spark.createDataFrame([(1, "some words")], DOCS), spark.createDataFrame([], ITEMS)
    assert [tuple(r)[2:] for r in contamination.judge_documents(documents, items).collect()] == [(2, 0, [])]
    assert contamination.judge_documents(documents.limit(0), spark.createDataFrame([(1, "some words")], ITEMS)).collect() == []
