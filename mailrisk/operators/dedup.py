"""Exact duplicates, conflicting labels and keep-first deduplication.

All grouping is done on SHA-256 digests (taken from the ``<text>_digest`` column
where a written table has one, so the text is not even read), so only fixed-size keys, one row key
and label bounds are shuffled, with map-side partial aggregation: a text that
makes up a third of the rows reaches its reducer as one row per map task. Full
rows move once, in a join on the unique row key, which cannot be skewed; the
number of tasks that read them follows their bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailrisk.operators.standardize import MAIL_COLUMNS

_PART_BYTES = 64 << 20  # text in the full rows that one task of the join reads


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def with_text_digest(mails: DataFrame, text: str = "text_combined") -> DataFrame:
    return mails.withColumn(f"{text}_digest", digest(F.col(text)))


def _text_digest(mails: DataFrame, text: str) -> Column:
    known = f"{text}_digest"
    return F.col(known) if known in mails.columns else digest(F.col(text))


def row_digest(columns: tuple[str, ...]) -> Column:
    """Digest of several columns; lengths make the concatenation unambiguous."""
    parts = []
    for name in columns:
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        parts += [F.length(text).cast("string"), F.lit(":"), text]
    return digest(F.concat(*parts))


def text_groups(mails: DataFrame, text: str = "text_combined") -> DataFrame:
    """One row per distinct text: size, first row key and label bounds."""
    return mails.groupBy(_text_digest(mails, text).alias("text_digest")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("row_key").alias("first_key"),
        F.min("label").alias("min_label"),
        F.max("label").alias("max_label"),
    )


def _parts(mails: DataFrame) -> int:
    """Tasks for the full rows: one per ``_PART_BYTES`` of text, at least one per core."""
    texts = [F.coalesce(F.octet_length(name), F.lit(0)).cast("long") for name, kind in mails.dtypes if kind == "string"]
    size = mails.agg(F.sum(sum(texts, F.lit(0).cast("long")))).first()[0] or 0
    return max(mails.sparkSession.sparkContext.defaultParallelism, -(-size // _PART_BYTES))


def _rows_of(mails: DataFrame, keys: DataFrame) -> DataFrame:
    """Full rows whose ``row_key`` is in ``keys``, as a left semi-join gives them.

    The number of partitions is set here: otherwise adaptive execution merges
    them, or, once it broadcasts the keys, has one task read all that a map task
    wrote, and what a task reads grows with the input. It is an inner join on
    distinct keys, as the optimizer moves a semi-join below the repartitioning.
    """
    parts = _parts(mails)
    distinct = keys.repartition(parts, "row_key").select("row_key").distinct()
    return mails.repartition(parts, "row_key").join(distinct, "row_key").select(*mails.columns)


def drop_exact_duplicates(mails: DataFrame, columns: tuple[str, ...] = MAIL_COLUMNS) -> DataFrame:
    """Keep the first of the rows that agree in all columns."""
    first = mails.groupBy(row_digest(columns).alias("digest")).agg(
        F.min("row_key").alias("row_key")
    )
    return _rows_of(mails, first.select("row_key"))


def deduplicate(mails: DataFrame, text: str = "text_combined") -> DataFrame:
    """Drop every text with conflicting labels; keep the first row of the others.

    Exact duplicates share their text, so keep-first covers them as well.
    """
    kept = (
        text_groups(mails, text)
        .where(F.col("min_label") == F.col("max_label"))
        .select(F.col("first_key").alias("row_key"))
    )
    return _rows_of(mails, kept)


def standardization_summary(standardized: DataFrame, usable: DataFrame) -> DataFrame:
    """Audit counters of a standardization run as ``(metric, value)`` rows."""
    loaded = standardized.agg(F.count(F.lit(1)).alias("rows_after_load"))
    exact = usable.groupBy(
        _text_digest(usable, "text_combined").alias("text_digest"),
        row_digest(MAIL_COLUMNS).alias("row_digest"),
    ).agg(F.count(F.lit(1)).alias("rows"), F.min("label").alias("label"))
    texts = exact.groupBy("text_digest").agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.min("label").alias("min_label"),
        F.max("label").alias("max_label"),
    )
    conflict = F.col("min_label") != F.col("max_label")
    kept = ~conflict
    counters = texts.agg(
        F.sum(F.col("rows") - F.col("distinct_rows")).alias("exact_removed"),
        F.sum(F.when(kept, F.col("distinct_rows") - 1).otherwise(0)).alias("text_removed"),
        F.count_if(conflict).alias("conflicting_texts"),
        F.sum(F.when(conflict, F.col("distinct_rows")).otherwise(0)).alias("conflict_rows"),
        F.count_if(kept).alias("rows_after_cleaning"),
        F.count_if(kept & (F.col("min_label") == 0)).alias("label_0"),
        F.count_if(kept & (F.col("min_label") == 1)).alias("label_1"),
    )
    wide = counters.select(
        loaded.scalar().alias("rows_before_cleaning"),
        loaded.scalar().alias("rows_after_load"),
        "rows_after_cleaning",
        (F.col("exact_removed") + F.col("text_removed")).alias("duplicate_rows_removed"),
        F.col("conflicting_texts").alias("conflicting_texts_removed"),
        F.col("conflict_rows").alias("conflicting_rows_removed"),
        "label_0",
        "label_1",
    )
    return to_metric_rows(wide)


def to_metric_rows(wide: DataFrame) -> DataFrame:
    """Turn a one-row table of counters into ``(metric, value)`` rows."""
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias("metric"), F.coalesce(F.col(name), F.lit(0)).cast("long").alias("value"))
            for name in wide.columns
        )
    )
    return wide.select(F.inline(pairs))
