from __future__ import annotations

import random

import numpy as np
import pytest

from mailrisk.llm import mixing


def corpus(count=600, seed=2):
    chance = random.Random(seed)
    words = [f"w{at}" for at in range(200)]
    rows, labels = [], []
    for doc_id in range(count):
        domain = "bad" if chance.random() < 0.3 else "fine"
        text = chance.choices(words, k=chance.randint(5, 60))
        if domain == "bad":
            text += chance.choices(["scum", "trash", "clown", "moron"], k=3)
        chance.shuffle(text)
        rows.append((doc_id, " ".join(text)))
        labels.append((doc_id, domain))
    return rows, labels


def rated(spark, rows, labels, mixture, **limits):
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, domain string")
    return mixing.rate_documents(documents, marks, mixture, mixing.Classifier(**limits)).collect()


def test_held_out_accuracy_and_targets(spark):
    rows, labels = corpus()
    result = rated(spark, rows, labels[:300], mixing.Mixture({"bad": 0.1, "fine": 0.9}))
    truth = dict(labels)
    right = [(r.posterior[0] > 0.5) == (truth[r.doc_id] == "bad") for r in result if r.doc_id >= 300]
    assert np.mean(right) > 0.97
    mass = np.array([np.array(r.posterior) * r.n_tokens * r.rate for r in result]).sum(axis=0)
    total = sum(r.n_tokens for r in result)
    assert np.allclose(mass / total, [0.1, 0.9], atol=0.01) and min(r.rate for r in result) >= 0


def test_rates_reach_the_least_squares_of_a_plain_solver(spark):
    rows, labels = corpus(200)
    mixture = mixing.Mixture({"bad": 0.0, "fine": 1.0}, anchor="fine", most_rate=1.0)
    result = rated(spark, rows, labels, mixture)
    masses = np.array([np.array(r.posterior) * r.n_tokens for r in result])
    present = masses.sum(axis=0)
    aims = np.array([0.0, present[1]])

    def loss(rate):
        return (((rate @ masses - aims) ** 2) / present).sum()

    rate = np.ones(len(masses))
    tokens = np.array([r.n_tokens for r in result], float)
    for _ in range(5000):
        pull = masses @ ((rate @ masses - aims) / present) / tokens
        rate = np.clip(rate - pull * 0.5, 0, 1)
    own = loss(np.array([r.rate for r in result]))
    assert own <= loss(rate) + 0.002 * present.sum()
    grid = [tuple(round(share * 32) for share in r.posterior) for r in result]
    assert len({(cell, r.rate) for cell, r in zip(grid, result)}) == len(set(grid))
    truth = dict(labels)
    assert all(r.rate > 0.99 for r in result if truth[r.doc_id] == "fine" and r.posterior[1] > 0.9)


def test_drawing_rows(spark):
    rows, labels = corpus(300)
    schema = "doc_id long, text string, rate string, posterior double, _copy string, copy int, _rate int, row int, times int, draw int, own_id int"
    documents = spark.createDataFrame([(*row, "x", 1.5, "c", 1, 2, 3, 4, 5, 6) for row in rows], schema)
    marks = spark.createDataFrame(labels, "doc_id long, domain string")
    mixture = mixing.Mixture({"bad": 0.0, "fine": 1.0}, anchor="fine", most_rate=1.0)
    kept = mixing.mix_documents(documents, marks, mixture)
    ids = [r.doc_id for r in kept.collect()]
    truth = dict(labels)
    assert kept.columns == documents.columns and len(ids) == len(set(ids))
    assert {r[2:] for r in kept.collect()} == {("x", 1.5, "c", 1, 2, 3, 4, 5, 6)}
    fine = {doc_id for doc_id, domain in labels if domain == "fine"}
    assert len(fine & set(ids)) >= 0.98 * len(fine)
    assert sum(truth[i] == "bad" for i in ids) <= 0.1 * (len(labels) - len(fine))
    doubled = mixing.mix_documents(documents, marks, mixing.Mixture({"bad": 0.5, "fine": 0.5}))
    counts = {r.doc_id: r["count"] for r in doubled.groupBy("doc_id").count().collect()}
    assert max(counts[i] for i in counts if truth[i] == "bad") >= 1


def test_special_rows(spark):
    rows, labels = corpus(120)
    odd = [(None, None), (None, "scum scum w1"), (900, ""), (901, None), (0, rows[0][1])]
    marks = labels + [(0, "fine"), (None, "bad"), (5000, "bad"), (1, None), (2, "unknown")]
    result = rated(spark, rows + odd, marks, mixing.Mixture({"bad": 0.2, "fine": 0.8}))
    found = {(r.doc_id, r.n_tokens) for r in result}
    assert {(None, 0), (None, 3), (900, 0), (901, 0), (0, 2 * len(rows[0][1].split()))} <= found
    assert all(abs(sum(r.posterior) - 1) < 1e-9 for r in result)
    empty = rated(spark, [], labels, mixing.Mixture({"bad": 0.5, "fine": 0.5}))
    assert empty == []
    unlabelled = rated(spark, rows, [], mixing.Mixture({"bad": 0.5, "fine": 0.5}))
    assert {tuple(r.posterior) for r in unlabelled} == {(0.5, 0.5)}


def test_weights_without_a_sum_are_refused():
    for weights, anchor in (({"a": 0.0}, None), ({}, None), ({"a": 1.0, "b": 0.0}, "b"), ({"a": 1.0}, "c"), ({"a": 2.0, "b": -1.0}, None)):
        with pytest.raises(ValueError):
            mixing.Mixture(weights, anchor=anchor)
