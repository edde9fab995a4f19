"""Vectors, split, metrics, similarity and learners against brute force."""

from __future__ import annotations

import dataclasses
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailrisk.operators import certificates, descent, evaluate, explain, learners, linear, similarity, split, svd, terms
from mailrisk.operators.bayes import fit_naive_bayes
from mailrisk.plans import training
from mailrisk.sources import sinks


def texts(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    words = [a + b for a in "bcdfgkl" for b in ("a", "e", "il", "on", "ur")]
    lines = [" ".join(rng.choice(words[: rng.choice((6, 20, 35))]) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    # A third of all mails are copies of one text, some others differ by one word.
    for i in range(0, n, 3):
        lines[i] = "ba ba ce dil fon kur la"
    for i in range(1, n, 9):
        lines[i] = lines[0] + " " + rng.choice(words)
    return lines


@pytest.fixture(scope="module")
def prepared(spark):
    lines = texts(180)
    rows = [(i, line, int("kur" in line.split()[:4] or i % 5 == 0)) for i, line in enumerate(lines)]
    mails = spark.createDataFrame(rows, "row_key long, text_combined string, label int")
    mails = mails.withColumn("source_file", F.concat(F.lit("src"), F.col("row_key") % 4))
    return training.prepare(split.stratified_split(mails))


def brute_force_vectors(lines, train):
    grams = []
    for line in lines:
        words = [w for w in line.split() if len(w) >= 2]
        grams.append(Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))
    df, total = Counter(), Counter()
    for i in train:
        df.update(grams[i].keys())
        total.update(grams[i])
    kept = sorted(t for t in df if 2 <= df[t] <= 0.95 * len(train))
    idf = {t: math.log((1 + len(train)) / (1 + df[t])) + 1 for t in kept}
    vectors = []
    for counts in grams:
        raw = {t: (1 + math.log(n)) * idf[t] for t, n in counts.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        vectors.append({t: v / norm for t, v in raw.items()})
    return kept, vectors


def test_vectors_and_similarity_match_brute_force(spark, prepared, monkeypatch):
    rows = prepared.vectors.orderBy("row_key").collect()
    train = [r.row_key for r in rows if not r.is_test]
    kept, expected = brute_force_vectors(texts(180), train)
    assert prepared.terms.terms == kept
    for row in rows:
        got = {kept[i]: w for i, w in zip(row.indices, row.weights)}
        assert got.keys() == expected[row.row_key].keys()
        assert all(abs(got[t] - w) < 1e-12 for t, w in expected[row.row_key].items())

    # Small groups force the splitting of hot terms.
    for name, size in (("_SHELF_ROWS", 5), ("_PART_ROWS", 7), ("_NEIGHBOURS", 2), ("_PIVOT_PART", 2), ("_FIRST_SETS", 1)):
        monkeypatch.setattr(similarity, name, size)
    keep = prepared.vectors.select("row_key", "is_test", "indices", "weights")
    found = similarity.max_similarity(keep.where("not is_test"), keep.where("is_test"), prepared.terms)
    found = {r.row_key: r.max_similarity for r in found.collect()}
    assert found.keys() == {r.row_key for r in rows if r.is_test}
    for key, value in found.items():
        best = max(sum(w * expected[t].get(g, 0.0) for g, w in expected[key].items()) for t in train)
        assert abs(value - best) < 1e-9


def test_vocabulary_limit_breaks_ties_by_term(spark):
    mails = spark.createDataFrame([("aa bb",), ("bb aa",), ("cc dd",), ("dd cc",)], "t string")
    assert terms.fit_terms(mails, "t", max_terms=3).terms == ["aa", "bb", "cc"]
    assert terms.fit_terms(mails, "t").terms == ["aa", "bb", "cc", "dd"]
    assert terms.fit_terms(mails.where("false"), "t").terms == []


@pytest.mark.parametrize("partitions", [1, 5])
def test_split_is_exact_and_independent_of_partitions(spark, partitions):
    mails = spark.range(1003).select(F.col("id").alias("row_key"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    sides = split.stratified_split(mails.repartition(partitions))
    counts = {(r.label, r.is_test): r["count"] for r in sides.groupBy("label", "is_test").count().collect()}
    quota = split.test_quota({0: 859, 1: 144})
    assert sum(quota.values()) == math.ceil(0.2 * 1003)
    assert {label: counts[label, True] for label in (0, 1)} == quota
    keys = {r.row_key for r in sides.where("is_test").collect()}
    assert keys == {r.row_key for r in split.stratified_split(mails).where("is_test").collect()}


def test_metric_goldens(spark):
    data = [(1, 0.9), (0, 0.8), (1, 0.8), (1, 0.4), (0, 0.3), (0, 0.1)]
    rows = [("m", i, label, int(score > 0.5), score) for i, (label, score) in enumerate(data)]
    rows += [("one class", i, 1, 1, 0.5 + i / 10) for i in range(3)]
    table = spark.createDataFrame(rows, "model string, row_key long, label int, predicted_label int, score double")
    got = {r.model: r for r in evaluate.evaluate(table).collect()}
    assert abs(got["m"].roc_auc - 0.833333) < 1e-6
    assert abs(got["m"].pr_auc - 0.805556) < 1e-6
    assert (got["m"].true_negative, got["m"].false_positive, got["m"].false_negative, got["m"].true_positive) == (2, 1, 1, 2)
    assert got["one class"].roc_auc is None and got["one class"].recall == 1.0


def test_ranking_over_many_ranges_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [("m", i, int(rng.random() < 0.3), 0, rng.choice((0.25, rng.random()))) for i in range(2000)]
    table = spark.createDataFrame(rows, "model string, row_key long, label int, predicted_label int, score double")
    got = evaluate.ranking_metrics(table).first()
    pos = np.array([r[4] for r in rows if r[2]])
    neg = np.array([r[4] for r in rows if not r[2]])
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert abs(got.roc_auc - auc) < 1e-12
    ap = sum(
        (pos == s).sum() / len(pos) * (pos >= s).sum() / ((pos >= s).sum() + (neg >= s).sum()) for s in set(pos)
    )
    assert abs(got.pr_auc - ap) < 1e-12


def test_exact_quantiles(spark):
    values = [0.0, 0.5, 1.0, 1.0, 1.0, 0.25, 0.123456, 0.123457]
    table = spark.createDataFrame([(v,) for v in values], "v double")
    got = similarity.exact_quantiles(table, "v", {"a": 0.5, "b": 0.9, "c": 0.1})
    assert np.allclose([got["a"], got["b"], got["c"]], np.quantile(values, [0.5, 0.9, 0.1]))


def dense(prepared):
    rows = prepared.train.orderBy("row_key").collect()
    x = np.zeros((len(rows), prepared.terms.size))
    for i, row in enumerate(rows):
        x[i, row.indices] = row.weights
    y = np.array([2 * row.label - 1 for row in rows])
    weights = split.balanced_weights(prepared.counts)
    return x, y, np.array([weights[row.label] for row in rows])


def test_logistic_and_svm_reach_the_minimum(prepared, monkeypatch):
    monkeypatch.setattr(descent, "_TOLERANCE", 1e-6)
    x, y, c = dense(prepared)
    model = learners.fit_logistic(prepared.train, prepared.terms, prepared.counts)
    w = np.array(model.coefficients)
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    assert np.abs(w - 0.5 * x.T @ (c * ((y == 1) - p))).max() < 2e-4
    assert abs((c * ((y == 1) - p)).sum()) < 4e-4
    machine = learners.fit_linear_svm(prepared.train, prepared.terms, prepared.counts)
    w = np.array(machine.coefficients)
    gap = np.maximum(0, 1 - y * (x @ w + machine.intercept))
    assert np.abs(w - x.T @ (c * gap * y)).max() < 2e-4
    assert abs(machine.intercept - (c * gap * y).sum()) < 2e-4


def test_sums_in_two_levels_equal_direct_sums(prepared, monkeypatch):
    from mailrisk.operators import sums

    rows = prepared.train.repartition(6).select("label", F.lit(1.0).alias("class_weight"), "indices", F.col("weights").alias("values"))
    rows = descent.pack(rows)
    point = np.linspace(-1, 1, prepared.terms.size + 1)
    direct = descent._pass(rows, 6, descent.logistic, point)
    monkeypatch.setattr(sums, "_FAN_IN", 2)
    monkeypatch.setattr(sums.sum_blocks, "__defaults__", (1,))
    levels = descent._pass(rows, 6, descent.logistic, point)
    assert abs(direct[0] - levels[0]) < 1e-9 and np.allclose(direct[1], levels[1])


def test_many_blocks_meet_in_a_tree(spark):
    from mailrisk.operators import sums

    blocks = spark.range(2000, numPartitions=20).selectExpr("0 AS stripe", "cast(id div 32 as int) AS salt", "id")

    def as_blocks(batches):
        import pyarrow as pa

        for batch in batches:
            cells = [np.array([float(i), 1.0]).tobytes() for i in batch.column("id").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("stripe"), batch.column("salt"), pa.array(cells)], names=["stripe", "salt", "block"])

    (total,) = sums.sum_blocks(blocks.mapInArrow(as_blocks, sums.BLOCK_SCHEMA), 2000, at_root=1)
    assert total.tolist() == [2000 * 1999 / 2, 2000.0]


def test_shipped_svd_settings_are_accurate(spark):
    """A flat spectrum of 400 rows and 600 terms at the shipped width and passes."""
    chance = np.random.default_rng(3)
    x = chance.random((400, 600)) * (chance.random((400, 600)) < 0.05) * (1 / np.arange(1, 601) ** 0.3)
    rows = [(i, np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for i, r in enumerate(x)]
    vectors = spark.createDataFrame(rows, "row_key long, indices array<int>, weights array<double>").repartition(3)
    model = svd.fit_svd(vectors, 600)
    exact = np.linalg.svd(x, compute_uv=False)[: svd.COMPONENTS]
    assert len(model.singular_values) == 100 and np.allclose(model.singular_values, exact, rtol=0.01)


def test_svd_matches_numpy(prepared):
    x, *_ = dense(prepared)
    model = svd.fit_svd(prepared.train, prepared.terms.size, components=10, tolerance=1e-3)
    exact = np.linalg.svd(x, compute_uv=False)[:10]
    assert np.allclose(model.singular_values, exact, rtol=1e-3)
    assert np.allclose(model.components.T @ model.components, np.eye(10), atol=1e-9)
    scores = np.array([r.components for r in model.transform(prepared.train.select("row_key", "indices", "weights")).orderBy("row_key").collect()])
    assert np.allclose(scores, x @ model.components)


def test_explanations_add_up_and_models_survive_saving(spark, prepared, tmp_path):
    model = training.fit_final_model(prepared)
    test = prepared.test
    n = prepared.terms.size + 10
    full = explain.explain_mails(model.decision(test), model, n).collect()
    for row in full:
        text = sum(model.coefficients[i] * w for i, w in zip(row.indices, row.weights))
        metadata = sum(e.contribution for e in row.metadata_contributions)
        assert abs(model.intercept + text + metadata - row.decision) < 1e-9
        contributions = [e.contribution for e in row.top_phishing_terms]
        assert contributions == sorted(contributions, reverse=True) and all(v > 0 for v in contributions)
    sinks.write_model(model, str(tmp_path / "lr"))
    loaded = linear.load_linear_model(spark, str(tmp_path / "lr"))
    assert loaded == model and linear.model_exists(spark, str(tmp_path / "lr"))
    assert not linear.model_exists(spark, str(tmp_path / "none"))
    report = explain.soc_report(test, model)
    assert "phishing probability" in report.first()["soc_explanation"]
    assert '"soc_explanation"' in sinks.report_text(report).first()[0]


def test_forest_survives_saving(spark, prepared, tmp_path):
    model = learners.fit_forest(prepared.train, prepared.terms, prepared.counts, prepared.scaler, trees=5)
    before = {r.row_key: r.score for r in model.predict(prepared.test).collect()}
    sinks.write_model(model, str(tmp_path / "rf"))
    after = {r.row_key: r.score for r in sinks.load_forest_model(spark, str(tmp_path / "rf")).predict(prepared.test).collect()}
    assert before == after


def test_naive_bayes_uses_the_whole_vocabulary(prepared):
    x, y, _ = dense(prepared)
    model = fit_naive_bayes(prepared.train, prepared.terms, prepared.counts)
    logs = [np.log((x[y == s].sum(0) + 1) / (x[y == s].sum() + x.shape[1])) for s in (1, -1)]
    assert np.allclose(model.coefficients, logs[0] - logs[1])


def test_holdout_notes(spark):
    rows = [("a", 0), ("a", 0), ("a", 1), ("a", 1), ("b", 1), ("c", 0), ("d", 0), ("d", 1)]
    mails = spark.createDataFrame(
        [(i, s, f"word{i % 2} common thing {label}", label) for i, (s, label) in enumerate(rows)],
        "row_key long, source_file string, text_combined string, label int",
    )
    experiments = (("to_b", ("a",), ("b",)), ("to_c", ("a",), ("c",)), ("to_d", ("a",), ("d",)), ("none", ("a",), ("x",)), ("few", ("d",), ("a",)))
    got = {r.experiment: r for r in training.source_holdout(mails, experiments).collect()}
    assert got["to_b"].phishing_recall is not None and got["to_b"].precision is None
    assert got["to_c"].recall is None and got["to_c"].accuracy is not None
    assert got["to_d"].roc_auc is not None and got["to_d"].note == "two-class external test set"
    assert (got["none"].status, got["none"].note) == ("skipped", "empty train or test split")
    assert got["few"].status == "skipped" and got["few"].accuracy is None and got["few"].true_positive == 0


def test_duality_gap_tells_how_far_a_model_is(prepared):
    train, counts = prepared.train, prepared.counts
    cases = (
        (learners.fit_logistic(train, prepared.terms, counts), learners.TEXT_C, "logistic", False),
        (training.fit_final_model(prepared), learners.METADATA_C, "logistic", False),
        (learners.fit_linear_svm(train, prepared.terms, counts), learners.TEXT_C, "squared_hinge", True),
    )
    for model, c, loss, penalized in cases:
        row = certificates.duality_gap(model, train, counts, c, loss, penalized).first()
        assert row.train_rows == sum(counts.values()) and -1e-9 <= row.relative_gap < 1e-3
        spoiled = dataclasses.replace(model, coefficients=[1.3 * value + 0.05 for value in model.coefficients])
        off = certificates.duality_gap(spoiled, train, counts, c, loss, penalized).first()
        assert off.primal > row.primal and off.dual <= row.primal + 1e-9 and off.relative_gap > 10 * row.relative_gap


def test_curves_do_not_depend_on_the_ranges(spark, monkeypatch):
    rows = [(f"m{at % 2}", at, at % 3 % 2, int(at % 7 > 3), (at * 37 % 50) / 50 if at % 11 else None) for at in range(300)]
    predictions = spark.createDataFrame(rows, "model string, row_key long, label int, predicted_label int, score double")
    whole = sorted(map(tuple, evaluate.cumulative_counts(predictions).collect()))
    monkeypatch.setattr(evaluate, "_RANGE_ROWS", 7)
    assert sorted(map(tuple, evaluate.cumulative_counts(predictions).collect())) == whole
    for model, score, _, _, tp, fp in whole:
        above = [r for r in rows if r[0] == model and r[4] is not None and r[4] >= score]
        assert (tp, fp) == (sum(r[2] for r in above), sum(1 - r[2] for r in above))


def test_terms_are_counted_and_weighed_in_batches(spark, monkeypatch):
    """F12, F13, F15 to F20: word codes and slices give the counts and weights of the texts."""
    monkeypatch.setattr(terms, "_SLICE_BYTES", 16)
    texts = [
        (1, 0, "ab c de ab de"), (2, 1, None), (3, 0, ""), (4, 1, "x 7"), (5, None, "Été ab<br>de &amp; ab de"),
        (6, 0, "www.a.example ab de"), (7, 1, "mail me@a.example 12 fast"), (8, None, "ab"), (9, 1, "ab de fast " * 40),
    ]
    mails = spark.createDataFrame(texts, "row_key long, label int, text_combined string").repartition(2)
    postings = terms.postings(mails, ("row_key", "label"))
    for by in (None, "label"):
        keys = [by] if by else []
        plain = postings.groupBy(*keys, "term").agg(F.sum("tf").alias("total_tf"), F.count("*").alias("df"))
        counted = terms.term_statistics(mails, by=by)
        everyone = {tuple(row)[len(keys):][1:] for row in counted.where("term = ''").collect()}
        assert everyone == ({(9, 9)} if by is None else {(3, 3), (4, 4), (2, 2)})
        assert sorted(map(str, plain.collect())) == sorted(map(str, counted.where("term != ''").collect()))
    model = terms.fit_terms(mails, max_share=1.0)
    position = {term: i for i, term in enumerate(model.terms)}
    assert "ab de" in position and "ab" in position
    wanted: dict[int, dict[int, float]] = {key: {} for key, *_ in texts}
    for row in postings.collect():
        if row["term"] in position:
            i = position[row["term"]]
            wanted[row["row_key"]][i] = (1 + math.log(row["tf"])) * model.idf[i]
    for row in model.vectorize(mails).collect():
        entries = wanted[row["row_key"]]
        norm = math.sqrt(sum(value * value for value in entries.values()))
        assert row["indices"] == sorted(entries)
        assert row["weights"] == pytest.approx([entries[i] / norm for i in sorted(entries)], rel=1e-12)
