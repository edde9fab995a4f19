"""Standardize feeds into the canonical mail table.

Two tables are written. The first holds every standardized row with a digest of
its text; the raw feeds are parsed and composed once, and duplicates are then
found from key, label and digest columns alone. The second is the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailrisk.functions.text import clean_value
from mailrisk.operators.dedup import deduplicate, digest, standardization_summary
from mailrisk.operators.standardize import MAIL_COLUMNS, standardize_feeds, usable_rows
from mailrisk.session import write_stage


@dataclass(frozen=True)
class StandardizationRun:
    standardized: DataFrame
    mails: DataFrame
    summary: DataFrame


def write_standardized(spark: SparkSession, feeds: Sequence[DataFrame]) -> DataFrame:
    """All rows in canonical columns; the digest is of the text after cleaning."""
    rows = standardize_feeds(spark, feeds)
    with_digest = rows.withColumn(
        "text_combined_digest", digest(clean_value(F.col("text_combined")))
    )
    return write_stage(with_digest, "standardized")


def write_mails(standardized: DataFrame) -> DataFrame:
    """Usable, conflict-free mails, the first of every text."""
    kept = deduplicate(usable_rows(standardized))
    return write_stage(kept.select("row_key", *MAIL_COLUMNS), "mails")


def standardize(spark: SparkSession, feeds: Sequence[DataFrame]) -> StandardizationRun:
    standardized = write_standardized(spark, feeds)
    return StandardizationRun(
        standardized=standardized.select("row_key", *MAIL_COLUMNS),
        mails=write_mails(standardized),
        summary=standardization_summary(standardized, usable_rows(standardized)),
    )
