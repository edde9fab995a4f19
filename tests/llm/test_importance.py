from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from mailrisk.llm import importance
from mailrisk.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def resampled(spark, rows, target, schema="doc_id long, text string", **rule):
    drawn = importance.resample(
        spark.createDataFrame(rows, schema), spark.createDataFrame([(t,) for t in target], "text string"), importance.Resampling(**rule)
    )
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in drawn.collect()), key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_against_plain_version(spark, longest):
    chance = random.Random(longest)
    words = ["tax", "Ærø", "x1", "the", "THE", "a", "naïve", "z"]
    rows = [(at, chance.choice([" ", "--", "\n.\x00"]).join(chance.choices(words, k=chance.randint(0, 60)))) for at in range(400)]
    target = ["the tax, the z", None, "x1 x1"]
    expected = brute.importance_draw(rows, target, longest)
    assert resampled(spark, rows, target, longest=longest) == expected
    assert sum(row[4] is not None for row in expected) > 20


def test_overlapped_matches_are_all_runs_of_words():
    words = importance.collapsed("  Aé-b  c\x7f1 \n".encode())
    assert words == "aé b c 1".encode()
    runs = [m.group().decode() for m in importance.gram_pattern(2).finditer(words, overlapped=True)]
    assert runs == ["aé b", "b c", "c 1"]
    assert importance.gram_buckets(b"", [importance.gram_pattern(1)], 7).tolist() == []


def test_special_rows(spark):
    text = "many words " * 15
    rows = [(None, text, 1), (None, text, 1), (5, text, 2), (5, text, 2), (6, None, 3), (7, "", 3), (8, "x " * 150_000, 4)]
    expected = brute.importance_draw([row[:2] for row in rows], [], percent=80)
    found = resampled(spark, rows, [], "doc_id long, text string, row int", longest=1, percent=80)
    assert found == expected and sorted(row[4] for row in found if row[4]) == [1, 2, 3, 4]
    assert resampled(spark, [], ["x"]) == []
    assert all(row[4] is None for row in resampled(spark, [(1, "too short")], ["x"], percent=100))
    with pytest.raises(ValueError):
        resampled(spark, rows[:0], [], "doc_id long, text string, row int", buckets=1 << 17)


def test_gains_are_floored():
    gains = importance.bucket_gains(np.array([0, 9]), np.array([0, 0]))
    assert gains.tolist() == [1704, -598]


def test_query(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("text").collect()]
    found = sorted((tuple(r) for r in QUERIES["op13_importance_draw"](spark, SF_DIR).collect()), key=str)
    assert found == brute.importance_draw(documents, target)
