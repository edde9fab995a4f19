"""Bring feeds with differing headers to the canonical mail schema.

A feed is a DataFrame with two engine columns, ``_row_key`` (unique, increasing
in file order) and ``_source_file``, plus the columns of its header. Header
resolution is metadata work on the driver; the data only sees projections.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailrisk.functions.labels import normalize_label
from mailrisk.functions.text import clean_value, collapse_spaces

ROW_KEY = "_row_key"
SOURCE = "_source_file"

# Canonical columns and the accepted header names of each field.
MAIL_COLUMNS = (
    "source_file", "sender", "receiver", "date", "subject", "body", "urls",
    "text_combined", "label",
)
HEADER_NAMES = {
    "sender": {"sender", "from", "from_email", "from_address", "sender_email", "mail_from"},
    "receiver": {"receiver", "recipient", "to", "to_email", "to_address", "receiver_email", "rcpt_to"},
    "date": {"date", "sent_date", "timestamp", "time"},
    "subject": {"subject", "email_subject"},
    "body": {"body", "message", "content", "email_body"},
    "urls": {"urls", "url", "links", "link", "uri", "uris"},
    "label": {"label", "class", "target", "category", "type", "is_phishing"},
    "text_combined": {"text_combined", "text", "email_text", "email", "message_text"},
}

STANDARD_SCHEMA = T.StructType(
    [T.StructField("row_key", T.LongType())]
    + [
        T.StructField(name, T.IntegerType() if name == "label" else T.StringType())
        for name in MAIL_COLUMNS
    ]
)


def normalize_column_name(name: object) -> str:
    """Lower-case header with blanks and hyphens as single underscores."""
    words = re.split(r"[\s_-]+", str(name).strip().lower())
    return "_".join(word for word in words if word)


def normalize_headers(names: Iterable[object]) -> list[str]:
    """Normalized headers; the n-th repetition of a name gets the suffix ``_n``."""
    seen: dict[str, int] = {}
    unique = []
    for name in map(normalize_column_name, names):
        seen[name] = seen.get(name, 0) + 1
        unique.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return unique


def find_header(headers: Sequence[str], field: str) -> str | None:
    """First header, in file order, accepted for a canonical field."""
    return next((header for header in headers if header in HEADER_NAMES[field]), None)


def standardize_feed(feed: DataFrame) -> DataFrame:
    """Project one feed to ``row_key`` and the canonical columns."""
    engine = (ROW_KEY, SOURCE)
    headers = normalize_headers(name for name in feed.columns if name not in engine)
    feed = _with_positional_names(feed)
    position = {header: F.col(f"c{i}") for i, header in enumerate(headers)}

    def text(field: str) -> Column:
        header = find_header(headers, field)
        return F.lit("") if header is None else clean_value(position[header])

    fields = {name: text(name) for name in ("sender", "receiver", "date", "subject", "body", "urls")}
    if find_header(headers, "text_combined") is not None:
        combined = text("text_combined")
    else:
        combined = collapse_spaces(
            F.concat_ws(" ", fields["subject"], fields["body"], fields["urls"])
        )
    label_header = find_header(headers, "label")
    label = F.lit(None).cast("int") if label_header is None else normalize_label(position[label_header])
    return feed.select(
        F.col(ROW_KEY).cast("long").alias("row_key"),
        F.col(SOURCE).alias("source_file"),
        *(column.alias(name) for name, column in fields.items()),
        combined.alias("text_combined"),
        label.alias("label"),
    )


def _with_positional_names(feed: DataFrame) -> DataFrame:
    """Rename positionally, so headers that differ only in case cannot clash."""
    positions = count()
    return feed.toDF(
        *(name if name in (ROW_KEY, SOURCE) else f"c{next(positions)}" for name in feed.columns)
    )


def standardize_feeds(spark: SparkSession, feeds: Sequence[DataFrame]) -> DataFrame:
    """Union of the standardized feeds; an empty canonical table without feeds."""
    if not feeds:
        return spark.createDataFrame([], STANDARD_SCHEMA)
    return reduce(DataFrame.unionByName, (standardize_feed(feed) for feed in feeds))


def usable_rows(mails: DataFrame) -> DataFrame:
    """Rows with a recognised label and non-empty text.

    Apply it to a written table: over an unwritten projection the optimizer
    would evaluate the text composition once more for the filter.
    """
    return (
        mails.where(F.col("label").isNotNull())
        .withColumn("text_combined", clean_value(F.col("text_combined")))
        .where(F.col("text_combined") != "")
    )
