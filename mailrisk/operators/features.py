"""Ten numeric security features per mail, and the model input table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailrisk.functions import links
from mailrisk.functions.mail import parse_mail
from mailrisk.functions.text import blank_if_missing, collapse_spaces, strip

# Feature names in model order.
METADATA_FEATURES = (
    "n_links", "has_ip_url", "html_tag_count", "html_ratio", "body_len", "subject_len",
    "n_exclamation", "n_upper_words", "sender_has_email", "url_count_from_column",
)
MODEL_INPUT = ("text_combined", *METADATA_FEATURES)
MAIL_PARTS = ("subject", "body", "urls", "sender")


def as_mail_table(mails: DataFrame) -> DataFrame:
    """Add absent mail parts as empty text, and compose ``text_combined`` if absent."""
    for name in MAIL_PARTS:
        if name not in mails.columns:
            mails = mails.withColumn(name, F.lit(""))
    if "text_combined" not in mails.columns:
        parts = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("subject", "body", "urls"))
        mails = mails.withColumn("text_combined", collapse_spaces(F.concat_ws(" ", *parts)))
    return mails


def parse_mail_table(texts: DataFrame, text: str) -> DataFrame:
    """Replace a column of pasted mails by the five parsed mail columns."""
    others = [name for name in texts.columns if name != text]
    return texts.select(*others, parse_mail(F.col(text)).alias("_mail")).select(*others, "_mail.*")


def with_metadata_features(mails: DataFrame) -> DataFrame:
    """Append the ten features; missing-value tokens in mail parts count as empty."""
    table = as_mail_table(mails)
    passed = table.columns
    subject, body, urls, sender, combined = (
        F.col(f"_{name}") for name in (*MAIL_PARTS, "text_combined")
    )
    # Nested selects name shared inputs once; Catalyst keeps them as separate
    # projections because they are costly and used by several features.
    table = table.select(
        *passed,
        *(blank_if_missing(F.col(name)).alias(f"_{name}") for name in (*MAIL_PARTS, "text_combined")),
    )
    table = table.select(
        *passed, "_subject", "_urls", "_sender",
        F.when(body == "", combined).otherwise(body).alias("_body"),
    )
    table = table.select(
        *passed, "_subject", "_urls", "_sender", "_body",
        strip(F.concat_ws(" ", subject, body)).alias("_text"),
        links.count_listed_urls(urls).alias("_listed"),
    )
    return table.select(*passed, *_features())


def _features() -> list[Column]:
    text, listed = F.col("_text"), F.col("_listed")
    secured = strip(F.concat_ws(" ", text, F.col("_urls")))
    values = {
        "n_links": F.greatest(links.count_feature_urls(text), listed),
        "has_ip_url": links.has_ip_link(secured),
        "html_tag_count": links.count_tags(text),
        "html_ratio": links.tag_characters(text) / F.greatest(F.length(text), F.lit(1)),
        "body_len": F.length("_body"),
        "subject_len": F.length("_subject"),
        "n_exclamation": F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit(""))),
        "n_upper_words": links.count_upper_words(text),
        "sender_has_email": links.has_address(F.col("_sender")),
        "url_count_from_column": listed,
    }
    return [values[name].cast("double").alias(name) for name in METADATA_FEATURES]


def model_input(mails: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, text with missing tokens blanked, and the ten features."""
    features = with_metadata_features(mails)
    return features.select(
        *keep, blank_if_missing(F.col("text_combined")).alias("text_combined"), *METADATA_FEATURES
    )
