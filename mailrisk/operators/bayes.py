"""Multinomial naive Bayes on TF-IDF weights, in closed form."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from mailrisk.operators.linear import LinearModel, sum_by_class
from mailrisk.operators.terms import TermModel

# Smoothing.
ALPHA = 1.0


def fit_naive_bayes(
    vectors: DataFrame, terms: TermModel, counts: dict[int, int], alpha: float = ALPHA
) -> LinearModel:
    """Smoothed log odds per term over the whole vocabulary, empirical prior.

    With two classes the model is linear: the coefficient of a term is the
    difference of its class log probabilities.
    """
    sums = sum_by_class(vectors, terms.size)
    total = {label: math.fsum(values) + alpha * terms.size for label, values in sums.items()}
    log_odds = [
        math.log((phishing + alpha) / total[1]) - math.log((legitimate + alpha) / total[0])
        for legitimate, phishing in zip(sums[0], sums[1])
    ]
    prior = math.log(counts[1]) - math.log(counts[0])
    return LinearModel("naive_bayes", terms, log_odds, prior)
