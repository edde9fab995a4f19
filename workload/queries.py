"""Registered queries: ``name -> callable(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailrisk.functions import labels, links, text
from mailrisk.functions.entities import decode_entities
from mailrisk.functions.mail import parse_mail
from mailrisk.operators import (
    bayes, certificates, dedup, evaluate, explain, features, learners, linear, profile, similarity, split,
    standardize, svd, terms,
)
from mailrisk.plans import standardization, training
from mailrisk.session import new_folder, write_stage
from mailrisk.sources import csv, sinks
from mailrisk.sources import tables as loading
from mailrisk.streaming import scoring
from workload import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), digits) for name in names})


# --- standardization ---------------------------------------------------------


@query
def q_clean_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.raw_mails(spark, sf_dir)
    names = ("sender", "receiver", "date", "subject", "urls")
    return raw.select("row_key", *(text.clean_value(F.col(name)).alias(name) for name in names))


@query
def q_normalize_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.raw_mails(spark, sf_dir)
    return raw.select("row_key", "raw_label", labels.normalize_label(F.col("raw_label")).alias("label"))


@query
def q_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run from the raw feeds, never from a table written earlier."""
    return standardization.standardize(spark, tables.feeds(spark, sf_dir)).mails


@query
def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = standardize.usable_rows(tables.standardized(spark, sf_dir))
    return dedup.drop_exact_duplicates(usable).select("row_key", "source_file", "label")


@query
def q_standardize_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = tables.standardized(spark, sf_dir)
    return dedup.standardization_summary(loaded, standardize.usable_rows(loaded))


@query
def q_load_eda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loading.load_for_profiling(tables.labelled_raw(spark, sf_dir))


@query
def q_load_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loading.load_for_training(tables.labelled_raw(spark, sf_dir))


# --- cleaning and features ---------------------------------------------------


@query
def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = tables.table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.clean_text(F.col("text")).alias("text_cleaned"))


@query
def q_clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.clean_text(F.col("html")).alias("text_cleaned"))


@query
def q_entity_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.table(spark, sf_dir, "pages")
    return pages.select("page_id", decode_entities(F.col("html")).alias("html"))


@query
def q_count_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        links.count_urls(F.col("html")).alias("cleaning_urls"),
        links.count_feature_urls(F.col("html")).alias("feature_urls"),
    )


@query
def q_url_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.raw_mails(spark, sf_dir)
    return raw.select("row_key", "urls", links.count_listed_urls(F.col("urls")).alias("url_count"))


@query
def q_parse_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    pasted = tables.pasted_mails(spark, sf_dir)
    return pasted.select("conv_id", "turn", parse_mail(F.col("mail")).alias("m")).select(
        "conv_id", "turn", "m.*"
    )


@query
def q_metadata_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = tables.standardized(spark, sf_dir)
    features_only = features.with_metadata_features(mails).select("row_key", *features.METADATA_FEATURES)
    return rounded(features_only, "html_ratio")


@query
def q_html_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of web pages: only a body and a URL column are present."""
    pages = tables.table(spark, sf_dir, "pages")
    mails = pages.select("page_id", F.col("html").alias("body"), F.col("url").alias("urls"))
    features_only = features.with_metadata_features(mails).select("page_id", *features.METADATA_FEATURES)
    return rounded(features_only, "html_ratio")


@query
def q_model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = tables.mails(spark, sf_dir)
    return rounded(features.model_input(mails, keep=("row_key",)), "html_ratio")


# --- profiling ---------------------------------------------------------------


def profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable mails before deduplication, so the audits have something to count."""
    return loading.load_for_profiling(standardize.usable_rows(tables.standardized(spark, sf_dir)))


@query
def q_class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.class_distribution(profiled(spark, sf_dir))


@query
def q_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.length_histogram(profiled(spark, sf_dir)), "bin_low", "bin_high")


@query
def q_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.missing_values(tables.standardized(spark, sf_dir)), "missing_rate")


@query
def q_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.source_distribution(tables.labelled_raw(spark, sf_dir)), "row_rate")


@query
def q_duplicate_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_statistics(profiled(spark, sf_dir))


@query
def q_cleaned_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = standardize.usable_rows(tables.standardized(spark, sf_dir))
    return profile.cleaned_duplicate_check(loading.load_for_training(usable))


@query
def q_cleaned_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = standardize.usable_rows(tables.standardized(spark, sf_dir))
    kept = profile.cleaned_deduplicated(loading.load_for_training(usable))
    return kept.select("row_key", "label", "text_cleaned")


@query
def q_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_terms_by_class(tables.mails(spark, sf_dir))


# --- terms, weights, split ---------------------------------------------------


def split_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(tables.mails(spark, sf_dir))


@query
def q_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_mails(spark, sf_dir).select("row_key", "label", "is_test")


@query
def q_class_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = tables.mails(spark, sf_dir)
    weighted = split.with_class_weight(mails, loading.class_counts(mails))
    return rounded(weighted.select("row_key", "label", "class_weight"), "class_weight")


@query
def q_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.postings(tables.mails(spark, sf_dir), ("row_key",))


def fitted_terms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, terms.TermModel]:
    mails = split_mails(spark, sf_dir).select("row_key", "label", "is_test", "text_combined")
    return mails, terms.fit_terms(mails.where(~F.col("is_test")))


@query
def q_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = fitted_terms(spark, sf_dir)
    return rounded(model.table(spark), "idf")


@query
def q_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails, model = fitted_terms(spark, sf_dir)
    weights = terms.long_weights(model.vectorize(mails), ("row_key",))
    return rounded(weights, "weight")


# --- evaluation on scores derived from features ------------------------------


def feature_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three simple scores per mail as if they were models, written once for the metrics."""
    mails = features.model_input(tables.mails(spark, sf_dir), keep=("row_key", "label", "source_file"))
    scores = F.array(
        F.struct(F.lit("by_links").alias("model"), (F.col("n_links") / (F.col("n_links") + 1.0)).alias("score")),
        F.struct(F.lit("by_length").alias("model"), (F.col("body_len") / (F.col("body_len") + 1500.0)).alias("score")),
        F.struct(F.lit("by_subject").alias("model"), ((F.col("subject_len") % 100) / 100.0).alias("score")),
    )
    scored = mails.select("row_key", "label", "text_combined", F.inline(scores))
    guess = (F.col("score") >= 0.5).cast("int")
    return write_stage(scored.withColumn("predicted_label", guess), "feature-predictions")


@query
def q_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = evaluate.evaluate(feature_predictions(spark, sf_dir))
    return rounded(metrics, *evaluate.METRICS)


@query
def q_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_counts(feature_predictions(spark, sf_dir))


@query
def q_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.roc_points(feature_predictions(spark, sf_dir)), "threshold", "fpr", "tpr", digits=9)


@query
def q_pr(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = evaluate.pr_points(feature_predictions(spark, sf_dir))
    return rounded(points, "threshold", "precision", "recall", "baseline", digits=9)


@query
def q_best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = evaluate.with_rates(evaluate.confusion_counts(feature_predictions(spark, sf_dir)))
    return rounded(evaluate.best_model(counts), "f1")


def _links_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_predictions(spark, sf_dir).where(F.col("model") == "by_links")


@query
def q_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.error_samples(_links_only(spark, sf_dir)), "phishing_probability")


@query
def q_sample_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = evaluate.sample_predictions(_links_only(spark, sf_dir))
    return rounded(samples, "phishing_probability", "risk_score")


EXPERIMENTS = (
    ("src1_src2_to_src3", ("src1", "SRC2"), ("src3",)),
    ("src4_to_src5", ("src4",), ("src5",)),
    ("absent_to_src5", ("absent",), ("src5",)),
)


@query
def q_source_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = tables.mails(spark, sf_dir)
    return mails.select(
        "row_key", "source_file",
        *(evaluate.source_mask(train).alias(f"in_{name}") for name, train, _ in EXPERIMENTS),
    )


@query
def q_holdout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.holdout_counts(tables.mails(spark, sf_dir), EXPERIMENTS)


# --- vectors, naive Bayes, near duplicates -----------------------------------


@query
def q_scaled_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = split_mails(spark, sf_dir)
    raw = features.model_input(mails, keep=("row_key", "is_test"))
    scaler = linear.fit_scaler(raw.where(~F.col("is_test")))
    scaled = linear.with_scaled_features(raw, scaler).select("row_key", *features.METADATA_FEATURES)
    return rounded(scaled, *features.METADATA_FEATURES)


def vector_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, terms.TermModel]:
    """Split mails with TF-IDF vectors and features, written once."""

    def build(spark: SparkSession, sf_dir: str):
        return training.prepare(split_mails(spark, sf_dir))

    prepared = tables._staged("vectors", build, spark, sf_dir)
    return prepared.vectors, prepared.terms


def bayes_model(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, linear.LinearModel]:
    vectors, model = vector_table(spark, sf_dir)
    train = vectors.where(~F.col("is_test"))
    return vectors, bayes.fit_naive_bayes(train, model, loading.class_counts(train))


@query
def q_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, model = bayes_model(spark, sf_dir)
    scored = model.predict(vectors.where("is_test"))
    return rounded(scored.select("row_key", "label", "predicted_label", "score"), "score")


@query
def q_naive_bayes_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = bayes_model(spark, sf_dir)
    return rounded(model.coefficient_table(spark).select("feature", "coefficient"), "coefficient")


def _similarities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    vectors, model = vector_table(spark, sf_dir)
    keep = vectors.select("row_key", "is_test", "indices", "weights")
    train, test = keep.where(~F.col("is_test")), keep.where("is_test")
    return similarity.max_similarity(train, test, model), train


@query
def q_max_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_similarities(spark, sf_dir)[0], "max_similarity")


@query
def q_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    similarities, train = _similarities(spark, sf_dir)
    check = similarity.near_duplicate_check(write_stage(similarities, "similarities"), train.count())
    return rounded(check, *(c for c in check.columns if "similarity" in c and not c.startswith("count")))


# --- scoring and explanation with a closed-form linear model -----------------


def closed_form_model(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, linear.LinearModel]:
    """Naive Bayes term weights plus metadata weights from class means.

    Every coefficient is an aggregate of the training mails, so SQL can follow
    scores and explanations exactly.
    """
    vectors, text_model = bayes_model(spark, sf_dir)
    train = vectors.where(~F.col("is_test"))
    scaler = linear.fit_scaler(train)
    scaled = linear.with_scaled_features(train, scaler)
    means = scaled.agg(
        *(
            (F.avg(F.when(F.col("label") == 1, F.col(n))) - F.avg(F.when(F.col("label") == 0, F.col(n)))).alias(n)
            for n in features.METADATA_FEATURES
        )
    ).first()
    model = dataclasses.replace(
        text_model, name="closed_form", scaler=scaler,
        metadata_coefficients=[means[n] for n in features.METADATA_FEATURES],
    )
    return vectors, model


@query
def q_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, model = closed_form_model(spark, sf_dir)
    scored = explain.score_mails(vectors.where("is_test"), model)
    return rounded(
        scored.select("row_key", "predicted_label", "prediction", "phishing_probability", "risk_score", "risk_level"),
        "phishing_probability", "risk_score",
    )


@query
def q_global_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = closed_form_model(spark, sf_dir)
    return rounded(explain.global_indicators(spark, model), "coefficient")


@query
def q_metadata_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = closed_form_model(spark, sf_dir)
    return rounded(explain.metadata_coefficients(spark, model), "coefficient")


@query
def q_explain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, model = closed_form_model(spark, sf_dir)
    explained = vectors.where("is_test").select("row_key", explain.text_contributions(model).alias("t"))
    rows = explained.select("row_key", F.posexplode_outer("t").alias("position", "e")).where("e is not null")
    rows = rows.select("row_key", (F.col("position") + 1).alias("rank"), "e.term", "e.tfidf_value", "e.coefficient", "e.contribution")
    return rounded(rows, "tfidf_value", "coefficient", "contribution")


@query
def q_explain_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, model = closed_form_model(spark, sf_dir)
    explained = vectors.where("is_test").select("row_key", explain.metadata_contributions(model).alias("m"))
    rows = explained.select("row_key", F.inline("m"))
    return rounded(rows, "raw_value", "scaled_value", "coefficient", "contribution")


@query
def q_soc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, model = closed_form_model(spark, sf_dir)
    report = explain.soc_report(vectors.where("is_test"), model)
    flat = report.withColumns(
        {
            "top_text_terms": F.array_join("top_text_contributions.term", "|"),
            "top_metadata_features": F.array_join("top_metadata_contributions.feature", "|"),
        }
    ).drop("top_text_contributions", "top_metadata_contributions")
    return rounded(flat, "phishing_probability", "risk_score")


@query
def q_soc_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry of both lists of the report, written as JSON rows and read back."""
    vectors, model = closed_form_model(spark, sf_dir)
    report = explain.soc_report(vectors.where("is_test"), model)
    folder = new_folder(spark, "report")
    sinks.write_json(report, folder)
    read = spark.read.schema(report.schema).json(folder)
    texts = read.select("true_label", F.posexplode("top_text_contributions").alias("position", "e")).select(
        "true_label", F.lit("text").alias("kind"), (F.col("position") + 1).alias("rank"), F.col("e.term").alias("name"),
        F.col("e.tfidf_value").alias("value"), "e.coefficient", "e.contribution",
    )
    metadata = read.select("true_label", F.posexplode("top_metadata_contributions").alias("position", "e")).select(
        "true_label", F.lit("metadata").alias("kind"), (F.col("position") + 1).alias("rank"), F.col("e.feature").alias("name"),
        F.col("e.scaled_value").alias("value"), "e.coefficient", "e.contribution",
    )
    return rounded(texts.unionByName(metadata), "value", "coefficient", "contribution")


@query
def q_score_pasted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse, vectorize and score pasted mails in batch."""
    _, model = closed_form_model(spark, sf_dir)
    scored = scoring.score_pasted(tables.pasted_mails(spark, sf_dir), "mail", model, ("conv_id", "turn"))
    return rounded(scored, "phishing_probability", "risk_score")


@query
def q_score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores from a file stream over all conversations."""
    _, model = closed_form_model(spark, sf_dir)
    schema = spark.read.parquet(f"{sf_dir}/conversations.parquet").schema
    # A glob: the table may be one file or a folder of files, and a stream takes no plain path to a file.
    arriving = spark.readStream.schema(schema).parquet(f"{sf_dir}/conversations.parque[t]")
    pasted = tables.pasted_mails_from(arriving)
    folder = new_folder(spark, "stream")
    running = scoring.start_scoring(
        pasted, "mail", model, ("conv_id", "turn"), f"{folder}/scores", f"{folder}/checkpoint"
    )
    running.awaitTermination()
    return rounded(spark.read.parquet(f"{folder}/scores"), "phishing_probability", "risk_score")


@query
def q_explain_pasted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry of both explanation lists of every scored mail, with its risk level."""
    _, model = closed_form_model(spark, sf_dir)
    scored = scoring.score_pasted(
        tables.pasted_mails(spark, sf_dir), "mail", model, ("conv_id", "turn"), explain=True
    )

    def entries_of(kind: str, column: str, name: str, value: str):
        return F.transform(
            column,
            lambda e: F.struct(
                F.lit(kind).alias("kind"), e[name].alias("name"), e[value].alias("value"),
                e["coefficient"].alias("coefficient"), e["contribution"].alias("contribution"),
            ),
        )

    entries = F.concat(
        entries_of("text", "top_phishing_terms", "term", "tfidf_value"),
        entries_of("metadata", "metadata_contributions", "feature", "scaled_value"),
    )
    listed = scored.select("conv_id", "turn", "risk_level", F.explode(entries).alias("entry"))
    return rounded(listed.select("conv_id", "turn", "risk_level", "entry.*"), "value", "coefficient", "contribution")


# --- iterative learners ------------------------------------------------------


def trained(spark: SparkSession, sf_dir: str) -> training.Prepared:
    vector_table(spark, sf_dir)
    return tables._staged("vectors", None, spark, sf_dir)


def _scores(spark: SparkSession, sf_dir: str, *models) -> DataFrame:
    return training.predictions(models, trained(spark, sf_dir).test)


@query
def q_lr_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = trained(spark, sf_dir)
    model = learners.fit_logistic(prepared.train, prepared.terms, prepared.counts)
    return _scores(spark, sf_dir, model)


@query
def q_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = trained(spark, sf_dir)
    return _scores(spark, sf_dir, learners.fit_linear_svm(prepared.train, prepared.terms, prepared.counts))


@query
def q_lr_text_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir, training.fit_final_model(trained(spark, sf_dir)))


@query
def q_linear_certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three linear learners with bounds on their distance from the optimum."""
    prepared = trained(spark, sf_dir)
    train, counts = prepared.train, prepared.counts
    text = learners.fit_logistic(train, prepared.terms, counts)
    svm = learners.fit_linear_svm(train, prepared.terms, counts)
    final = training.fit_final_model(prepared)
    gaps = certificates.duality_gap(text, train, counts, learners.TEXT_C, "logistic", False).unionByName(
        certificates.duality_gap(svm, train, counts, learners.TEXT_C, "squared_hinge", True)
    ).unionByName(certificates.duality_gap(final, train, counts, learners.METADATA_C, "logistic", False))
    sizes = F.lit(prepared.terms.size).cast("long").alias("vocabulary")
    return gaps.select("model", "train_rows", sizes, F.round("relative_gap", 3).alias("relative_gap"), (F.col("dual") <= F.col("primal")).alias("bounded"))


@query
def q_svd(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = trained(spark, sf_dir)
    model = svd.fit_svd(prepared.train, prepared.terms.size)
    return model.transform(prepared.test.select("row_key", "indices", "weights")).select("row_key", "components")


@query
def q_svd_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and energy of the matrix, and whether the pairs hold what they claim: residuals
    within the limit, vectors at right angles, projections with the energy of the values."""
    prepared = trained(spark, sf_dir)
    model = svd.fit_svd(prepared.train, prepared.terms.size)
    values = model.singular_values**2
    small = bool((model.residuals <= svd._TOLERANCE * values).all())
    angles = model.components.T @ model.components
    projected = model.transform(prepared.train.select("row_key", "indices", "weights"))
    square = F.aggregate("components", F.lit(0.0), lambda total, one: total + one * one)
    entries = F.aggregate("weights", F.lit(0.0), lambda total, one: total + one * one)
    row = projected.agg(F.sum(square).alias("held"), F.sum(entries).alias("energy"), F.count(F.lit(1)).alias("n")).first()
    kept = abs(row["held"] - values.sum()) <= 1e-6 * row["energy"] and row["held"] <= row["energy"]
    right = bool(abs(angles - np.eye(len(values))).max() < 1e-8)
    return spark.createDataFrame(
        [(row["n"], len(values), round(row["energy"], 6), small, right, bool(kept))],
        "train_rows long, components long, energy double, residuals_within boolean, orthogonal boolean, energy_kept boolean",
    )


@query
def q_random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = trained(spark, sf_dir)
    model = learners.fit_forest(prepared.train, prepared.terms, prepared.counts, prepared.scaler)
    return _scores(spark, sf_dir, model)


@query
def q_dedup_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = standardize.usable_rows(tables.standardized(spark, sf_dir))
    return training.cleaned_dedup_benchmark(loading.load_for_training(usable))


@query
def q_source_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.source_holdout(tables.mails(spark, sf_dir), EXPERIMENTS)


@query
def q_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a saved and reloaded model."""
    vectors, model = closed_form_model(spark, sf_dir)
    folder = new_folder(spark, "model")
    sinks.write_model(model, folder)
    scored = explain.score_mails(vectors.where("is_test"), linear.load_linear_model(spark, folder))
    return rounded(scored.select("row_key", "phishing_probability"), "phishing_probability")


# --- CSV in and out ----------------------------------------------------------


@query
def q_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the raw feeds as CSV folders, read them back and standardize them."""
    folder = new_folder(spark, "raw-csv")
    for i, feed in enumerate(tables.feeds(spark, sf_dir)):
        plain = feed.drop("_source_file").withColumnRenamed("_row_key", "Row Id")
        sinks.write_csv(plain, f"{folder}/feed{i}")
    feeds = csv.read_feeds(spark, folder)
    standard = standardize.standardize_feeds(spark, feeds)
    mails = standardize.usable_rows(write_stage(standard, "csv-standardized"))
    return mails.select("sender", "receiver", "date", "subject", "body", "urls", "text_combined", "label")


@query
def q_csv_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files as they come: a byte order mark, Windows-1252, an undefined byte, quoted line
    breaks, headers that clash or are quoted, short, over-long and empty rows."""
    folder = new_folder(spark, "raw-variants")
    csv.allow_windows_encoding(spark)
    variants = tables.csv_variants(spark, sf_dir)
    for name, (header, encoding) in tables.VARIANTS.items():
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # every file starts with a header
        line = F.when(first, F.concat(F.lit(header + "\n"), F.col("record"))).otherwise(F.col("record"))
        rows = variants.where(F.col("variant") == name).select(F.encode(line, encoding).cast("string").alias("value"))
        rows.write.text(f"{folder}/{name}")
    feeds = csv.read_feeds(spark, folder, "*.txt")
    standard = write_stage(standardize.standardize_feeds(spark, feeds), "csv-variants")
    return standard.select("sender", "subject", "body", "urls", "text_combined", "label")


@query
def q_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail table written as CSV and read back by the loader of the training step."""
    folder = new_folder(spark, "sink")
    sinks.write_csv(tables.mails(spark, sf_dir), folder)
    (feed,) = csv.read_feeds(spark, folder)
    return loading.load_for_training(feed.drop("_row_key", "_source_file")).select(
        F.col("row_key").cast("long").alias("row_key"), "source_file", "label", "text_combined"
    )
