"""Label vocabulary: free-form class names to 0 (legitimate) or 1 (phishing)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailrisk.functions.text import SPACE, WORD, clean_value

# Accepted class names.
PHISHING_LABELS = ("phishing", "phish", "spam", "malicious", "bad", "true", "yes", "1")
LEGITIMATE_LABELS = ("legitimate", "legit", "ham", "benign", "safe", "false", "no", "0")

DECIMAL = rf"\A[{SPACE}]*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[{SPACE}]*\z"


def normalize_label(value: Column) -> Column:
    """Return 0, 1 or null. One trailing ``.0`` and all punctuation are ignored."""
    name = F.regexp_replace(F.lower(clean_value(value)), r"\.0\z", "")
    name = F.regexp_replace(name, rf"(?:[^{WORD}]|[_{SPACE}])+", " ")
    name = F.btrim(name, F.lit(" "))
    return (
        F.when(name.isin(*PHISHING_LABELS), 1)
        .when(name.isin(*LEGITIMATE_LABELS), 0)
        .cast("int")
    )


def numeric_label(value: Column) -> Column:
    """Read an already standardized 0/1 label; anything else becomes null.

    Only decimal numbers count: a cast alone also takes ``1d`` or ``0x1p0``.
    """
    number = F.when(value.cast("string").rlike(DECIMAL), value.try_cast("double"))
    return F.when(number.isin(0.0, 1.0), number).cast("int")
