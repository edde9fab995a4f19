"""Load a standardized mail table for profiling or for training."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailrisk.functions.labels import numeric_label
from mailrisk.functions.text import strip
from mailrisk.operators.standardize import ROW_KEY, SOURCE
from mailrisk.sources import csv

REQUIRED = ("text_combined", "label")
_ROWS_PER_FILE_BITS = 33


def read_canonical(spark: SparkSession, path: str) -> DataFrame:
    """A stored standardized table (a parquet table, or a folder of CSV files)
    with a ``row_key`` that grows with the sorted file path and the row in it.

    A table that already has a ``row_key`` keeps it.
    """
    feeds = csv.read_feeds(spark, path)
    if feeds:
        rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), feeds)
        return rows.drop(ROW_KEY, SOURCE) if "row_key" in rows.columns else rows.withColumnRenamed(ROW_KEY, "row_key").drop(SOURCE)
    rows = spark.read.parquet(path)
    if "row_key" in rows.columns:
        return rows
    located = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    order = Window.orderBy("_file")  # one row per file
    positions = located.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_file", (F.row_number().over(order) - 1).cast("long").alias("_position")
    )
    key = F.shiftleft("_position", _ROWS_PER_FILE_BITS) + F.col("_row")
    return located.join(positions, "_file").withColumn("row_key", key).drop("_file", "_row", "_position")


def _require_columns(mails: DataFrame) -> None:
    missing = sorted(set(REQUIRED) - set(mails.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def load_for_profiling(mails: DataFrame) -> DataFrame:
    """Null text becomes ``''`` (empty texts stay); rows without a 0/1 label go."""
    _require_columns(mails)
    return (
        mails.withColumn("text_combined", F.coalesce("text_combined", F.lit("")))
        .withColumn("label", numeric_label(F.col("label")))
        .where(F.col("label").isNotNull())
    )


def load_for_training(mails: DataFrame) -> DataFrame:
    """As for profiling, but text is stripped, empty texts go, sources are filled."""
    _require_columns(mails)
    source = F.col("source_file") if "source_file" in mails.columns else F.lit(None)
    return (
        mails.withColumn("text_combined", strip(F.coalesce("text_combined", F.lit(""))))
        .withColumn("label", numeric_label(F.col("label")))
        .withColumn("source_file", F.coalesce(source.cast("string"), F.lit("unknown")))
        .where(F.col("label").isNotNull() & (F.col("text_combined") != ""))
    )


def class_counts(mails: DataFrame) -> dict[int, int]:
    """Rows per label; at most two rows reach the driver."""
    return {row["label"]: row["count"] for row in mails.groupBy("label").count().collect()}


def require_two_classes(mails: DataFrame) -> dict[int, int]:
    """Raise unless both classes have at least two rows; return the counts."""
    counts = class_counts(mails)
    if not counts:
        raise ValueError("No usable rows found in standardized data.")
    if len(counts) < 2 or min(counts.values()) < 2:
        raise ValueError("Training requires at least two examples from each class.")
    return counts
