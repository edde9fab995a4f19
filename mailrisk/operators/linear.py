"""Linear mail models: scaler, scoring, explanations, persistence.

Any learner that ends in coefficients (logistic regression, squared-hinge SVM,
multinomial naive Bayes) becomes a ``LinearModel``. Scoring and explaining are
row-wise expressions without a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailrisk.functions.risk import EVALUATION_THRESHOLD, sigmoid
from mailrisk.operators.features import METADATA_FEATURES
from mailrisk.operators.terms import TermModel, literal_array


@dataclass(frozen=True)
class MetadataScaler:
    """Mean and population standard deviation per feature (1 where it is 0)."""

    mean: list[float]
    scale: list[float]

    def scaled(self) -> list[Column]:
        return [
            (F.col(name) - F.lit(mean)) / F.lit(scale)
            for name, mean, scale in zip(METADATA_FEATURES, self.mean, self.scale)
        ]


def fit_scaler(features: DataFrame) -> MetadataScaler:
    """One aggregation over the training features."""
    row = features.agg(
        *(F.avg(name).alias(f"mean_{name}") for name in METADATA_FEATURES),
        *(F.stddev_pop(name).alias(f"std_{name}") for name in METADATA_FEATURES),
    ).first()
    return MetadataScaler(
        mean=[row[f"mean_{name}"] for name in METADATA_FEATURES],
        scale=[row[f"std_{name}"] or 1.0 for name in METADATA_FEATURES],
    )


def with_scaled_features(features: DataFrame, scaler: MetadataScaler) -> DataFrame:
    return features.withColumns(dict(zip(METADATA_FEATURES, scaler.scaled())))


@dataclass(frozen=True)
class LinearModel:
    """Coefficients over a vocabulary and, optionally, the scaled metadata."""

    name: str
    terms: TermModel
    coefficients: list[float]
    intercept: float
    scaler: MetadataScaler | None = None
    metadata_coefficients: list[float] = field(default_factory=list)
    has_probability: bool = True

    def coefficient_table(self, spark: SparkSession) -> DataFrame:
        """``kind, feature, coefficient``."""
        names = [*self.terms.terms, *(METADATA_FEATURES if self.metadata_coefficients else ())]
        kinds = ["text"] * self.terms.size + ["metadata"] * len(self.metadata_coefficients)
        return spark.createDataFrame(
            pa.table(
                {
                    "kind": pa.array(kinds, pa.string()),
                    "feature": pa.array(names, pa.string()),
                    "coefficient": pa.array([*self.coefficients, *self.metadata_coefficients], pa.float64()),
                }
            )
        )

    def decision(self, vectors: DataFrame) -> DataFrame:
        """Append ``decision``; ``vectors`` has indices, weights and raw features."""
        weights = literal_array(self.coefficients)
        terms = F.zip_with("indices", "weights", lambda i, value: value * F.get(weights, i))
        total = F.aggregate(terms, F.lit(0.0), lambda acc, value: acc + value) + F.lit(self.intercept)
        if self.scaler is not None:
            for value, coefficient in zip(self.scaler.scaled(), self.metadata_coefficients):
                total = total + value * F.lit(coefficient)
        return vectors.withColumn("decision", total)

    def predict(self, vectors: DataFrame) -> DataFrame:
        """Append ``predicted_label`` and ``score`` at the learner's own threshold.

        ``score`` is P(phishing), or the decision value of a model without one.
        """
        decided = self.decision(vectors)
        if not self.has_probability:
            return decided.withColumns(
                {"predicted_label": (F.col("decision") > 0).cast("int"), "score": F.col("decision")}
            ).drop("decision")
        scored = decided.withColumn("score", sigmoid(F.col("decision")))
        guess = (F.col("score") > EVALUATION_THRESHOLD).cast("int")
        return scored.withColumn("predicted_label", guess).drop("decision")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as two small parquet tables."""
        table = self.terms.arrow().append_column("coefficient", pa.array(self.coefficients, pa.float64()))
        spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(f"{path}/terms")
        header = {
            "name": self.name, "intercept": self.intercept, "has_probability": self.has_probability,
            "n_documents": self.terms.n_documents,
            "metadata_coefficients": self.metadata_coefficients,
            "scaler": None if self.scaler is None else [self.scaler.mean, self.scaler.scale],
        }
        spark.createDataFrame([(json.dumps(header),)], "header string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/header")


def load_linear_model(spark: SparkSession, path: str) -> LinearModel:
    """Read a saved model; a clear error when there is none."""
    try:
        header = json.loads(spark.read.parquet(f"{path}/header").first()["header"])
    except Exception as error:
        raise FileNotFoundError(f"Model not found at {path}; train and save one first.") from error
    rows = spark.read.parquet(f"{path}/terms").orderBy("term_id").toArrow()
    terms = TermModel(
        rows["term"].to_pylist(), rows["total_tf"].to_pylist(), rows["df"].to_pylist(),
        header["n_documents"],
    )
    return LinearModel(
        name=header["name"], terms=terms, coefficients=rows["coefficient"].to_pylist(),
        intercept=header["intercept"], has_probability=header["has_probability"],
        scaler=None if header["scaler"] is None else MetadataScaler(*header["scaler"]),
        metadata_coefficients=header["metadata_coefficients"],
    )


def model_exists(spark: SparkSession, path: str) -> bool:
    try:
        load_linear_model(spark, path)
    except FileNotFoundError:
        return False
    return True


def sum_by_class(vectors: DataFrame, size: int) -> dict[int, Sequence[float]]:
    """Total weight per class and term; at most two vocabulary-sized arrays."""
    pairs = F.arrays_zip(F.col("indices").alias("i"), F.col("weights").alias("w"))
    long = vectors.select("label", F.explode_outer(pairs).alias("p")).select("label", "p.i", "p.w")
    sums = long.where(F.col("i").isNotNull()).groupBy("label", "i").agg(F.sum("w").alias("w")).toArrow()
    totals = {0: [0.0] * size, 1: [0.0] * size}
    for label, i, w in zip(*(sums[name].to_pylist() for name in ("label", "i", "w"))):
        totals[label][i] = w
    return totals
