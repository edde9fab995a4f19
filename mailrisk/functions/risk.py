"""Risk score, risk level and decision thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Level bounds on the 0-100 score, the two decision thresholds, names.
LEVEL_BOUNDS = ((40, "Low"), (70, "Medium"), (90, "High"))
TOP_LEVEL = "Critical"
SCORING_THRESHOLD = 0.7
EVALUATION_THRESHOLD = 0.5
CLASS_NAMES = {0: "legitimate", 1: "phishing"}


def risk_score(probability: Column) -> Column:
    return probability * 100.0


def risk_level(score: Column) -> Column:
    level = None
    for bound, name in LEVEL_BOUNDS:
        level = F.when(score < bound, name) if level is None else level.when(score < bound, name)
    return level.otherwise(TOP_LEVEL)


def class_name(label: Column) -> Column:
    return F.when(label == 1, CLASS_NAMES[1]).otherwise(CLASS_NAMES[0])


def sigmoid(score: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-score))
