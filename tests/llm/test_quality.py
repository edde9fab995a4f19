from __future__ import annotations

import random

import brute
import corpus_pipeline
from pyspark.sql import functions as F

from mailrisk.llm import quality

NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    "n_removed_lines", "n_removed_words",
)


def judged(spark, rows):
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    result = quality.judge_documents(documents).select("doc_id", *(F.col(f"quality.{n}") for n in NAMES))
    return {row[0]: tuple(row[1:]) for row in result.collect()}


def corpus():
    chance = random.Random(3)
    words = [f"w{at}" for at in range(400)]
    rows = []
    for doc_id in range(60):
        body = "\n".join(" ".join(chance.choices(words, k=12)) for _ in range(3))
        rows.append((doc_id, f"Home |  Menu\tÜber uns\n{body}\n\n", "a" if doc_id % 3 else "b"))
    rows += [(100, "x y z " * 30, "a"), (101, "home | menu ÜBER uns\n" * 9 + "one two three", "a")]
    rows += [(102, "a b c d e f g h " * 2 + " ".join(words[:60]), "c"), (103, " \t\r\n\x0b", "c"), (104, "", None), (105, None, None)]
    rows += [(106, "same line\nsame line\n \nsame  line", "a"), (107, "é" * 50 + " " + "日本 " * 30, "b")]
    return rows


def test_against_plain_version(spark):
    rows = corpus()
    assert judged(spark, rows) == brute.quality(rows)


def test_lines_are_removed_and_depleted_documents_rejected(spark):
    rows = corpus()
    documents = spark.createDataFrame(
        [(*row, 7, "kept column") for row in rows], "doc_id long, text string, source string, n_chars long, _words string"
    )
    result = {row.doc_id: row for row in quality.filter_documents(documents).collect()}
    expected = brute.quality(rows)
    assert set(result) == {doc_id for doc_id, measures in expected.items() if measures[6]}
    assert expected[101][8] and 101 not in result
    assert all("Menu" not in row.text and row.n_chars == len(row.text) for row in result.values() if row.doc_id < 60)
    assert {row._words for row in result.values()} == {"kept column"}


def test_repeated_rows_count_once_and_empty_tables(spark):
    rows = [(at, "shared line of words\n" + " ".join(f"v{at}x{n}" for n in range(30)), "h") for at in range(11)]
    alone = judged(spark, rows[:10] * 3)
    assert not any(measures[7] for measures in alone.values())
    assert all(measures[7] == 1 for measures in judged(spark, rows).values())
    assert judged(spark, []) == {}


def test_common_line_of_a_large_host_goes(spark):
    chance = random.Random(5)
    body = lambda: " ".join(chance.choices([f"w{at}" for at in range(900)], k=25))
    rows = [(at, ("Subscribe to  OUR letter\n" if at % 25 == 0 else "") + body(), "large") for at in range(500)]
    rows += [(500, "subscribe to our letter\n" * 9 + "w1 w2", "large"), (501, "subscribe to our letter\n" + body(), "small")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    stage = dict(corpus_pipeline.STAGES)["quality_rules"]
    kept = {row.doc_id: row.text for row in stage(spark, documents, "").collect()}
    expected = brute.quality(rows, max_share=0.0)
    assert sum(measures[7] for measures in expected.values()) == 20 + 9
    assert set(kept) == {doc_id for doc_id, measures in expected.items() if measures[6]} == set(range(502)) - {500}
    assert {doc_id for doc_id, text in kept.items() if "letter" in text} == {501}
    same = quality.judge_documents(documents).select("doc_id", *(F.col(f"quality.{n}") for n in NAMES))
    assert {row[0]: tuple(row[1:]) for row in same.collect()} == expected
    shared = quality.judge_documents(documents, quality.LineRules(max_share=0.05))
    assert shared.filter("quality.n_removed_lines > 0").count() == 0  # 4.2 % of the host


def test_long_text(spark):
    text = " ".join(f"t{at % 5000}" for at in range(12_000))
    measures = judged(spark, [(1, text, "h")])[1]
    assert measures[0] == 12_000 and measures[4] == brute.repeated_words(text.split())
