"""Profiling tables of a loaded mail table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailrisk.functions.risk import class_name
from mailrisk.functions.text import clean_text
from mailrisk.operators.dedup import deduplicate, digest, to_metric_rows, with_text_digest
from mailrisk.operators.standardize import MAIL_COLUMNS
from mailrisk.operators.terms import MIN_DOCUMENTS, term_statistics
from mailrisk.session import write_stage

# Histogram and term list sizes.
HISTOGRAM_BINS = 40
CLIP_QUANTILE = 0.99
TOP_TERMS = 30


def class_distribution(mails: DataFrame) -> DataFrame:
    """``label, row_count`` for both labels, zero-filled."""
    counts = mails.agg(*(F.count_if(F.col("label") == label).alias(f"n{label}") for label in (0, 1)))
    return counts.select(F.expr("stack(2, 0, n0, 1, n1) AS (label, row_count)"))


def length_histogram(mails: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Text lengths per class, clipped at the class 99th percentile, in equal bins.

    Works on counts per distinct length, whose number is bounded by the longest
    text and not by the number of mails.
    """
    lengths = mails.groupBy("label", F.length("text_combined").alias("length")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    bounds = lengths.groupBy("label").agg(
        F.percentile("length", F.lit(CLIP_QUANTILE), F.col("rows")).alias("clip"),
        F.min("length").cast("double").alias("low"),
    )
    # Two rows, one per class; a clipped range of width zero is widened by one half.
    bounds = bounds.select(
        "label", "clip",
        F.when(F.col("clip") > F.col("low"), F.col("low")).otherwise(F.col("low") - 0.5).alias("low"),
        F.when(F.col("clip") > F.col("low"), F.col("clip")).otherwise(F.col("low") + 0.5).alias("high"),
    )
    value = F.least(F.col("length").cast("double"), F.col("clip"))
    position = F.floor((value - F.col("low")) * bins / (F.col("high") - F.col("low")))
    counted = (
        lengths.join(F.broadcast(bounds), "label")
        .groupBy("label", F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.sum("rows").alias("row_count"))
    )
    width = (F.col("high") - F.col("low")) / bins
    grid = bounds.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counted, ["label", "bin"], "left").select(
        "label", "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"),
    )


def missing_values(mails: DataFrame, columns: tuple[str, ...] = MAIL_COLUMNS) -> DataFrame:
    """Null or empty values per column, as count and share."""
    total = F.greatest(F.count(F.lit(1)), F.lit(1))
    counted = mails.agg(
        total.alias("_total"),
        *(
            F.count_if(F.col(name).isNull() | (F.col(name).cast("string") == "")).alias(name)
            for name in columns
        ),
    )
    rows = F.array(
        *(F.struct(F.lit(name).alias("column"), F.col(name).alias("missing_count")) for name in columns)
    )
    return counted.select("_total", F.inline(rows)).select(
        "column", "missing_count", (F.col("missing_count") / F.col("_total")).alias("missing_rate")
    )


def source_distribution(mails: DataFrame) -> DataFrame:
    """Mails per source with their share; null and empty sources are ``unknown``."""
    source = F.when(F.coalesce("source_file", F.lit("")) == "", "unknown").otherwise(F.col("source_file"))
    counts = mails.groupBy(source.alias("source_file")).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.greatest(F.sum("row_count"), F.lit(1))).scalar()
    return counts.withColumn("row_rate", F.col("row_count") / total).orderBy(
        F.desc("row_count"), "source_file"
    )


def _text_group_sizes(mails: DataFrame) -> DataFrame:
    """Group sizes by raw and by cleaned text, in one scan and one small shuffle."""
    cleaned = clean_text(F.col("text_combined"))
    digests = mails.select(
        F.array(digest(F.col("text_combined")), digest(cleaned)).alias("digests"), "label"
    )
    return (
        digests.select("label", F.posexplode_outer("digests").alias("kind", "digest"))
        .groupBy("kind", "digest")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("label").alias("min_label"),
            F.max("label").alias("max_label"),
        )
    )


def duplicate_statistics(mails: DataFrame) -> DataFrame:
    """Repeated rows and texts, raw and cleaned (empty cleaned texts count too)."""
    raw, cleaned = F.col("kind") == 0, F.col("kind") == 1
    extra = F.col("rows") - 1
    repeated = F.col("rows") > 1
    return to_metric_rows(
        _text_group_sizes(mails).agg(
            F.sum(F.when(raw, F.col("rows"))).alias("rows"),
            F.sum(F.when(raw, extra)).alias("duplicate_rows_text_combined"),
            F.count_if(raw & repeated).alias("duplicate_groups_text_combined"),
            F.sum(F.when(cleaned, extra)).alias("duplicate_rows_text_cleaned"),
            F.count_if(cleaned & repeated).alias("duplicate_groups_text_cleaned"),
            F.count_if(cleaned).alias("rows_after_drop_duplicate_text_cleaned"),
        )
    )


def cleaned_mails(mails: DataFrame) -> DataFrame:
    """Mails with ``text_cleaned``, without those that have no cleaned text.

    Written once: the cleaned text feeds a filter, a digest and later training,
    and would otherwise be computed for each of them.
    """
    cleaned = mails.withColumn("text_cleaned", clean_text(F.col("text_combined")))
    stage = write_stage(with_text_digest(cleaned, "text_cleaned"), "cleaned")
    return stage.where(F.col("text_cleaned") != "")


def cleaned_deduplicated(mails: DataFrame) -> DataFrame:
    """One mail per cleaned text; texts with conflicting labels are dropped."""
    return deduplicate(cleaned_mails(mails), "text_cleaned")


def cleaned_duplicate_check(mails: DataFrame) -> DataFrame:
    """Duplicate and conflict counters of a training table by cleaned text."""
    empty = hashlib.sha256(b"").hexdigest()
    cleaned = clean_text(F.col("text_combined"))
    made = mails.select("label", F.array(digest(F.col("text_combined")), digest(cleaned)).alias("both"))
    digests = made.select(
        "label",
        F.transform("both", lambda own: F.struct(own.alias("digest"), F.get(F.col("both"), F.lit(1)).alias("cleaned"))).alias("pair"),
    )
    # An empty cleaned text takes its raw digest along, so both are left out. Each
    # exploded entry carries the cleaned digest: a filter on anything else would
    # be pushed below the generator and repeat the whole cleaning.
    groups = (
        digests.select("label", F.posexplode("pair").alias("kind", "entry"))
        .where(F.col("entry.cleaned") != empty)
        .groupBy("kind", F.col("entry.digest").alias("digest"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("label").alias("min_label"),
            F.max("label").alias("max_label"),
        )
    )
    by_raw, by_cleaned = F.col("kind") == 0, F.col("kind") == 1
    conflict = F.col("min_label") != F.col("max_label")
    return to_metric_rows(
        groups.agg(
            F.sum(F.when(by_cleaned, F.col("rows"))).alias("rows_before_cleaned_dedup"),
            F.sum(F.when(by_raw, F.col("rows") - 1)).alias("duplicate_rows_text_combined"),
            F.sum(F.when(by_cleaned, F.col("rows") - 1)).alias("duplicate_rows_text_cleaned"),
            F.count_if(by_cleaned & conflict).alias("conflicting_cleaned_texts"),
            F.sum(F.when(by_cleaned & conflict, F.col("rows"))).alias(
                "rows_removed_conflicting_cleaned_labels"
            ),
            F.count_if(by_cleaned & ~conflict).alias("rows_after_drop_duplicate_text_cleaned"),
        )
    )


def top_terms_by_class(mails: DataFrame, n: int = TOP_TERMS) -> DataFrame:
    """Most frequent words and word pairs per class, found in at least two mails.

    ``row_number() <= n`` is pruned inside every map task before the shuffle.
    """
    totals = (
        term_statistics(mails, by="label")
        .where((F.col("term") != "") & (F.col("df") >= MIN_DOCUMENTS))
        .withColumnRenamed("total_tf", "count")
    )
    ranked = Window.partitionBy("label").orderBy(F.desc("count"), "term")
    return (
        totals.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= n)
        .select("label", class_name(F.col("label")).alias("class_name"), "term", "count")
    )
