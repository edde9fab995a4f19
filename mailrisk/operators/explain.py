"""Scores with risk levels, coefficient explanations and the analyst report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailrisk.functions.risk import SCORING_THRESHOLD, class_name, risk_level, risk_score, sigmoid
from mailrisk.functions.text import bind
from mailrisk.operators.features import METADATA_FEATURES
from mailrisk.operators.linear import LinearModel
from mailrisk.operators.terms import literal_array

# List sizes of the reports.
TOP_INDICATORS = 20
TOP_CONTRIBUTIONS = 10
PREVIEW_CHARACTERS = 700
DRIVERS_NAMED = 3


def score_mails(vectors: DataFrame, model: LinearModel) -> DataFrame:
    """Append class, probability, score and level at the scoring threshold."""
    probability = sigmoid(F.col("decision"))
    scored = model.decision(vectors).withColumn("phishing_probability", probability)
    score = risk_score(F.col("phishing_probability"))
    label = (F.col("phishing_probability") >= SCORING_THRESHOLD).cast("int")
    return scored.withColumns(
        {
            "predicted_label": label,
            "prediction": class_name(label),
            "risk_score": score,
            "risk_level": risk_level(score),
        }
    ).drop("decision")


def global_indicators(spark: SparkSession, model: LinearModel, n: int = TOP_INDICATORS) -> DataFrame:
    """The ``n`` highest and ``n`` lowest text coefficients."""
    text = model.coefficient_table(spark).where(F.col("kind") == "text")
    sides = (
        ("phishing", F.desc("coefficient")),
        ("legitimate", F.asc("coefficient")),
    )
    parts = [
        text.orderBy(order, "feature").limit(n).select(
            F.lit(name).alias("class_name"), F.col("feature").alias("term"), "coefficient"
        )
        for name, order in sides
    ]
    return parts[0].unionByName(parts[1])


def metadata_coefficients(spark: SparkSession, model: LinearModel) -> DataFrame:
    """Metadata coefficients, highest first; empty for a text-only model."""
    table = model.coefficient_table(spark).where(F.col("kind") == "metadata")
    return table.select("feature", "coefficient").orderBy(F.desc("coefficient"), "feature")


def text_contributions(model: LinearModel, n: int = TOP_CONTRIBUTIONS) -> Column:
    """Array of the ``n`` terms that push most toward phishing, per mail."""
    weights = literal_array(model.coefficients)
    names = literal_array(model.terms.terms, "string")
    entries = F.zip_with(
        "indices", "weights",
        lambda i, value: F.struct(
            (-value * F.get(weights, i)).alias("order"), i.alias("i"), value.alias("value")
        ),
    )
    # Term ids follow the alphabet, so ties are in term order.
    positive = F.filter(entries, lambda e: (e["order"] < 0) & (e["value"] > 0))
    return F.transform(
        F.slice(F.array_sort(positive), 1, n),
        lambda e: F.struct(
            F.get(names, e["i"]).alias("term"),
            e["value"].alias("tfidf_value"),
            F.get(weights, e["i"]).alias("coefficient"),
            (-e["order"]).alias("contribution"),
        ),
    )


def metadata_contributions(model: LinearModel, n: int = TOP_CONTRIBUTIONS) -> Column:
    """Array of metadata features by absolute contribution, per mail."""
    if model.scaler is None:
        return F.expr(
            "cast(array() as array<struct<feature:string,raw_value:double,scaled_value:double,"
            "coefficient:double,contribution:double,direction:string>>)"
        )
    rows = []
    columns = zip(METADATA_FEATURES, model.scaler.scaled(), model.metadata_coefficients)
    for position, (name, scaled, coefficient) in enumerate(columns):
        contribution = scaled * F.lit(coefficient)
        rows.append(
            F.struct(
                (-F.abs(contribution)).alias("order"),
                F.lit(position).alias("position"),
                F.struct(
                    F.lit(name).alias("feature"),
                    F.col(name).alias("raw_value"),
                    scaled.alias("scaled_value"),
                    F.lit(coefficient).alias("coefficient"),
                    contribution.alias("contribution"),
                    F.when(contribution > 0, "toward_phishing")
                    .otherwise("toward_legitimate").alias("direction"),
                ).alias("entry"),
            )
        )
    return F.transform(F.slice(F.array_sort(F.array(*rows)), 1, n), lambda row: row["entry"])


def explain_mails(vectors: DataFrame, model: LinearModel, n: int = TOP_CONTRIBUTIONS) -> DataFrame:
    """Append both explanation arrays."""
    return vectors.withColumns(
        {
            "top_phishing_terms": text_contributions(model, n),
            "metadata_contributions": metadata_contributions(model, n),
        }
    )


def _named(entries: Column, field: str, fallback: str) -> Column:
    joined = F.array_join(F.transform(F.slice(entries, 1, DRIVERS_NAMED), lambda e: e[field]), ", ")
    return bind(joined, lambda text: F.when(text == "", fallback).otherwise(text))


def soc_report(vectors: DataFrame, model: LinearModel) -> DataFrame:
    """The riskiest predicted-phishing mail (else the riskiest) with its explanation.

    The mail is picked first, so only one row is explained.
    """
    chosen = (
        model.predict(vectors)
        .orderBy(F.desc("predicted_label"), F.desc("score"), "row_key")
        .limit(1)
    )
    report = chosen.withColumns(
        {
            "top_text_contributions": text_contributions(model),
            "top_metadata_contributions": metadata_contributions(model),
        }
    )
    score = risk_score(F.col("score"))
    # Wording of the report.
    sentence = F.format_string(
        "The model assigns %.3f phishing probability. Top text drivers include %s; "
        "top metadata drivers include %s. Review the message body, links, and sender "
        "context before action.",
        F.col("score"),
        _named(F.col("top_text_contributions"), "term", "no active text terms"),
        _named(F.col("top_metadata_contributions"), "feature", "no metadata signals"),
    )
    return report.select(
        F.substring("text_combined", 1, PREVIEW_CHARACTERS).alias("original_email_preview"),
        F.col("label").alias("true_label"),
        "predicted_label",
        class_name(F.col("predicted_label")).alias("predicted_class"),
        F.col("score").alias("phishing_probability"),
        score.alias("risk_score"),
        risk_level(score).alias("risk_level"),
        "top_text_contributions",
        "top_metadata_contributions",
        sentence.alias("soc_explanation"),
    )
