"""Train, evaluate, audit and explain models on a canonical mail table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailrisk.operators import evaluate, explain, profile, similarity
from mailrisk.operators.bayes import fit_naive_bayes
from mailrisk.operators.features import METADATA_FEATURES, model_input
from mailrisk.operators.learners import ForestModel, fit_forest, fit_linear_svm, fit_logistic
from mailrisk.operators.linear import LinearModel, MetadataScaler, fit_scaler
from mailrisk.operators.split import stratified_split
from mailrisk.operators.terms import TermModel, fit_terms
from mailrisk.session import write_stage
from mailrisk.sources.tables import class_counts, load_for_training, require_two_classes

FINAL_MODEL = "logistic_regression_text_metadata"


@dataclass(frozen=True)
class Prepared:
    """Written table of split mails with vectors, and what was fitted on its training side."""

    vectors: DataFrame
    terms: TermModel
    counts: dict[int, int]
    scaler: MetadataScaler | None = None

    @property
    def train(self) -> DataFrame:
        return self.vectors.where(~F.col("is_test"))

    @property
    def test(self) -> DataFrame:
        return self.vectors.where("is_test")


def with_features(mails: DataFrame) -> DataFrame:
    """The written model input of ``mails``; a table that has it already stays as
    it is, so that several fits share one evaluation of the mail expressions."""
    if set(METADATA_FEATURES) <= set(mails.columns):
        return mails
    keep = [name for name in ("row_key", "label", "is_test", "source_file") if name in mails.columns]
    return write_stage(model_input(mails, keep=tuple(keep)), "model-input")


def prepare(mails: DataFrame) -> Prepared:
    """Features for all mails; vocabulary and scaler from the training side only.

    ``mails`` has ``is_test``. Features and text are written before the
    vocabulary is counted, so the mail expressions run once per mail.
    """
    prepared = prepare_text(with_features(mails))
    return Prepared(prepared.vectors, prepared.terms, prepared.counts, fit_scaler(prepared.train))


def prepare_text(mails: DataFrame, text: str = "text_combined") -> Prepared:
    """Vectors of a written, split mail table; the vocabulary sees training mails only."""
    terms = fit_terms(mails.where(~F.col("is_test")), text)
    vectors = write_stage(terms.vectorize(mails, text), "vectors")
    return Prepared(vectors, terms, class_counts(vectors.where(~F.col("is_test"))))


def fit_text_models(prepared: Prepared) -> list[LinearModel]:
    """Naive Bayes, logistic regression and SVM on text."""
    train, terms, counts = prepared.train, prepared.terms, prepared.counts
    return [
        fit_naive_bayes(train, terms, counts),
        fit_logistic(train, terms, counts),
        fit_linear_svm(train, terms, counts),
    ]


def fit_final_model(prepared: Prepared) -> LinearModel:
    """Logistic regression on text and metadata."""
    return fit_logistic(prepared.train, prepared.terms, prepared.counts, prepared.scaler)


def predictions(models: Sequence[LinearModel | ForestModel], test: DataFrame) -> DataFrame:
    """Written ``model, row_key, label, predicted_label, score`` of all models."""
    parts = [
        model.predict(test).select(
            F.lit(model.name).alias("model"), "row_key", "label", "predicted_label", "score"
        )
        for model in models
    ]
    return write_stage(reduce(DataFrame.unionByName, parts), "predictions")


def cleaned_dedup_benchmark(mails: DataFrame) -> DataFrame:
    """Metrics of the text models after deduplication by cleaned text."""
    kept = profile.cleaned_deduplicated(mails).select("row_key", "label", "text_cleaned")
    kept = write_stage(kept, "cleaned-dedup")
    counts = class_counts(kept)
    if len(counts) < 2 or min(counts.values()) < 2:
        # Status and reason of a skipped benchmark.
        return mails.sparkSession.createDataFrame(
            [("all", "skipped", "cleaned deduplicated data does not contain two valid classes")],
            "model string, status string, reason string",
        )
    prepared = prepare_text(write_stage(stratified_split(kept), "cleaned-split"), "text_cleaned")
    return evaluate.evaluate(predictions(fit_text_models(prepared), prepared.test))


def source_holdout(mails: DataFrame, experiments=evaluate.HOLDOUT_EXPERIMENTS) -> DataFrame:
    """Train the final model on some sources and test it on others, per experiment."""
    if "source_file" not in mails.columns:
        # Status and note without sources.
        return mails.sparkSession.createDataFrame(
            [("all", FINAL_MODEL, "skipped", "source_file column is missing")],
            "experiment string, model string, status string, note string",
        )
    mails = with_features(mails)
    counts = write_stage(evaluate.holdout_counts(mails, experiments), "holdout-counts")
    ready = {row["experiment"] for row in counts.where("status = 'ok'").select("experiment").collect()}
    parts = []
    for name, train, test in experiments:
        if name not in ready:
            continue
        # A mail may be on both sides when keywords overlap.
        in_train, in_test = evaluate.source_mask(train), evaluate.source_mask(test)
        sides = F.explode(
            F.filter(
                F.array(F.when(in_train, F.lit(False)), F.when(in_test, F.lit(True))),
                lambda side: side.isNotNull(),
            )
        )
        prepared = prepare(mails.where(in_train | in_test).withColumn("is_test", sides))
        scored = predictions([fit_final_model(prepared)], prepared.test)
        parts.append(scored.withColumn("model", F.lit(name)))
    if not parts:
        schema = "model string, row_key long, label int, predicted_label int, score double"
        parts = [mails.sparkSession.createDataFrame([], schema)]
    return evaluate.holdout_metrics(counts, reduce(DataFrame.unionByName, parts), FINAL_MODEL)


@dataclass(frozen=True)
class TrainingRun:
    """Result tables and fitted models of one training run."""

    models: dict[str, LinearModel | ForestModel]
    tables: dict[str, DataFrame]

    def save(self, folder: str) -> None:
        """Write the result tables and the three models that are kept."""
        from mailrisk.sources.sinks import write_model, write_results

        write_results(self.tables, f"{folder}/results")
        for name in ("logistic_regression", FINAL_MODEL, "random_forest_text_metadata"):
            if name in self.models:
                write_model(self.models[name], f"{folder}/models/{name}")


def train(mails: DataFrame, experiments=evaluate.HOLDOUT_EXPERIMENTS, with_forest: bool = True) -> TrainingRun:
    """The whole workflow on a canonical mail table with a ``row_key``."""
    spark = mails.sparkSession
    if "row_key" not in mails.columns:
        raise ValueError("the mails need a unique row_key; read_canonical gives every row of a stored table one")
    loaded = write_stage(load_for_training(mails), "training")
    require_two_classes(loaded)
    inputs = with_features(loaded)
    prepared = prepare(stratified_split(inputs))
    text_models = fit_text_models(prepared)
    final = fit_final_model(prepared)
    models = [*text_models, final]
    if with_forest:
        models.append(fit_forest(prepared.train, prepared.terms, prepared.counts, prepared.scaler))
    scored = predictions(models, prepared.test)
    metrics = write_stage(evaluate.evaluate(scored), "metrics")
    text_names = [model.name for model in text_models]

    keep = prepared.vectors.select("row_key", "is_test", "indices", "weights")
    train_side = keep.where(~F.col("is_test"))
    similarities = write_stage(
        similarity.max_similarity(train_side, keep.where("is_test"), prepared.terms), "similarities"
    )
    final_scores = scored.where(F.col("model") == FINAL_MODEL).join(
        prepared.test.select("row_key", "text_combined"), "row_key"
    )
    tables = {
        "cleaned_duplicate_check": profile.cleaned_duplicate_check(loaded),
        "metrics_optimized": metrics.where(F.col("model").isin(*text_names)),
        "metrics_text_metadata": metrics,
        "confusion": evaluate.confusion_counts(scored),
        "roc_curve": evaluate.roc_points(scored),
        "pr_curve": evaluate.pr_points(scored),
        "best_model": evaluate.best_model(metrics),
        "near_duplicate_check": similarity.near_duplicate_check(
            similarities, sum(prepared.counts.values())
        ),
        "error_samples": evaluate.error_samples(final_scores),
        "sample_predictions": evaluate.sample_predictions(final_scores),
        "top_indicators": explain.global_indicators(spark, text_models[1]),
        "top_indicators_text_metadata": explain.global_indicators(spark, final),
        "metadata_coefficients": explain.metadata_coefficients(spark, final),
        "sample_soc_explanation": explain.soc_report(prepared.test, final),
        "metrics_cleaned_dedup": cleaned_dedup_benchmark(loaded),
        "source_holdout_metrics": source_holdout(inputs, experiments),
    }
    return TrainingRun({model.name: model for model in models}, tables)
