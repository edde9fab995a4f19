"""Native column expressions for missing values, stripping and text cleaning.

Java's ``\\s``, ``\\w`` and ``\\b`` differ from the Unicode rules the results
follow, so whitespace and word characters are spelled out as classes. Nothing
here leaves the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailrisk.functions.entities import decode_entities

# The 29 characters that count as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Character classes (inside brackets) and the missing-value tokens.
SPACE = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"\p{L}\p{N}_"
NULL_TOKENS = ("", "nan", "none", "null", "na", "n/a", "<na>")
_TOKEN_ALTERNATIVES = "nan|none|null|na|n/a|<na>"

# The cleaning patterns, applied in this order to lower-cased text.
MARKUP = r"<[^>]+>"
LINK = rf"(?:https?://|www\.)[^{SPACE}]+"
ADDRESS = rf"(?<![{WORD}])[{WORD}.%+-]++@[{WORD}.-]+\.[a-zA-Z]{{2,}}(?![{WORD}])"
NUMBER = rf"(?=\p{{Nd}})(?<![{WORD}])\p{{Nd}}+(?:\.\p{{Nd}}+)?(?![{WORD}])"
NOT_A_LETTER = r"[^a-z]+"


def strip(value: Column) -> Column:
    """Remove surrounding whitespace, Unicode whitespace included."""
    return F.btrim(value, F.lit(WHITESPACE))


def collapse_spaces(value: Column) -> Column:
    """Replace every whitespace run by one blank and strip the ends."""
    return F.btrim(F.regexp_replace(value, rf"[{SPACE}]+", " "), F.lit(" "))


def clean_value(value: Column) -> Column:
    """Strip, and map null and missing-value tokens to the empty string.

    The token pattern is anchored, so it is decided on the first characters and
    ``value`` is referenced once (an expensive input is not evaluated twice).
    """
    return F.regexp_replace(
        strip(F.coalesce(value.cast("string"), F.lit(""))),
        rf"(?i)\A(?:{_TOKEN_ALTERNATIVES})\z",
        "",
    )


def blank_if_missing(value: Column) -> Column:
    """Map null and missing-value tokens to ``''``; keep other values unstripped."""
    return F.regexp_replace(
        F.coalesce(value.cast("string"), F.lit("")),
        rf"(?i)\A[{SPACE}]*+(?:{_TOKEN_ALTERNATIVES})?[{SPACE}]*+\z",
        "",
    )


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times (a one-element transform)."""
    return F.get(F.transform(F.array(value), body), 0)


def _replace_if(value: Column, needles: tuple[str, ...], pattern: str, replacement: str) -> Column:
    """``regexp_replace`` for texts that contain a needle; others skip the scan."""
    return bind(
        value,
        lambda text: F.when(
            reduce(Column.__or__, (text.contains(needle) for needle in needles)),
            F.regexp_replace(text, F.lit(pattern), F.lit(replacement)),
        ).otherwise(text),
    )


def with_placeholders(value: Column) -> Column:
    """Lower-case text without entities and markup, with url/email/num placeholders."""
    text = F.lower(decode_entities(F.coalesce(value, F.lit(""))))
    text = _replace_if(text, ("<",), MARKUP, " ")
    text = _replace_if(text, ("http", "www."), LINK, " url ")
    text = _replace_if(text, ("@",), ADDRESS, " email ")
    return F.regexp_replace(text, NUMBER, " num ")


def clean_text(value: Column) -> Column:
    """Bring message text to lower-case words with url/email/num placeholders."""
    return F.btrim(F.regexp_replace(with_placeholders(value), NOT_A_LETTER, " "), F.lit(" "))
