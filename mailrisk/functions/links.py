"""Link, markup and address expressions behind the metadata features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailrisk.functions.text import LINK, NULL_TOKENS, SPACE, WORD, strip

# The feature patterns (the link tail stops at quotes and brackets).
FEATURE_LINK = rf"(?i)(?:https?://|www\.)[^{SPACE}<>'\")]+"
IP_LINK = r"(?:\p{Nd}{1,3}\.){3}\p{Nd}{1,3}(?::\p{Nd}{2,5})?(?:/|\z)"
TAG = rf"<[{SPACE}]*/?[{SPACE}]*[a-zA-Z][^>]*>"
EMAIL_ADDRESS = rf"(?<![{WORD}])[{WORD}.%+-]+@[{WORD}.-]+\.[a-zA-Z]{{2,}}(?![{WORD}])"
UPPER_WORD = rf"(?<![{WORD}])[A-Z]{{2,}}(?![{WORD}])"
LIST_SEPARATOR = rf"[,;|][{SPACE}]*"
LIST_BRACKETS = "[](){}"
QUOTES = "'\""


def count_urls(text: Column) -> Column:
    """Links by the cleaning pattern (tail runs to the next whitespace)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"(?i){LINK}"))


def count_feature_urls(text: Column) -> Column:
    """Links by the feature pattern."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(FEATURE_LINK))


def find_feature_urls(text: Column) -> Column:
    """All links by the feature pattern, as an array."""
    return F.regexp_extract_all(text, F.lit(FEATURE_LINK), F.lit(0))


def count_listed_urls(value: Column) -> Column:
    """Links stored in a URL column: pattern hits, else the number of list items."""
    text = strip(F.coalesce(value.cast("string"), F.lit("")))
    hits = count_feature_urls(text)
    items = F.transform(
        F.split(F.btrim(text, F.lit(LIST_BRACKETS)), LIST_SEPARATOR),
        lambda item: F.btrim(strip(item), F.lit(QUOTES)),
    )
    named = F.filter(items, lambda item: ~F.lower(item).isin(*NULL_TOKENS))
    return (
        F.when(F.lower(text).isin(*NULL_TOKENS), 0)
        .when(hits > 0, hits)
        .otherwise(F.size(named))
    )


def has_ip_link(text: Column) -> Column:
    return text.rlike(IP_LINK)


def count_tags(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TAG))


def tag_characters(text: Column) -> Column:
    """Number of characters inside markup tags."""
    return F.length(text) - F.length(F.regexp_replace(text, TAG, ""))


def count_upper_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(UPPER_WORD))


def has_address(text: Column) -> Column:
    return text.rlike(EMAIL_ADDRESS)
