"""Mixing domains to target weights with soft memberships.

A classifier learned from a labelled table gives every document a posterior over
domains. Documents get nonnegative rates such that the expected tokens of each
domain, ``sum(rate * tokens * posterior)``, come as near to the targets as they
can: the squared misses, each over the domain's present tokens, are lowered by
projected gradient steps from equal rates.

The gradient of a rate depends on the posterior alone, so documents of one
posterior always have one rate. Posteriors are rounded to a grid for this and
their exact token masses summed per cell: one pass over the documents, after
which every step sums a table whose size the grid bounds.

Defined results. Null texts have no words: prior posterior, no tokens. Labels
without a domain, and labels without a document, are not learned from; without
any label all posteriors are equal. Rows repeated under one id and text are one
document with the tokens of all, and a null id is an id like any other. Extra
columns are ignored by the fit and passed through by ``mix_documents``. An
empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailrisk.llm.contamination import folded_words
from mailrisk.session import Stage, new_stage, write_stage

_SIGNS = "#*$%&|<>!?"


@dataclass(frozen=True)
class Classifier:
    """Naive Bayes over the presence of words and three shape marks. It learns
    from at most ``most_labelled`` labelled rows, those with the smallest hash of
    their id, and keeps tokens that speak for some domain: ``least_lift`` is
    the log of how much more common they are there, ``least_deviation`` how many
    standard deviations; the ``most_features`` farthest stay. Both limits bound
    what is sent to the tasks. Exact copies are learned from once."""

    most_labelled: int = 20_000
    most_features: int = 10_000
    least_deviation: float = 5.0
    least_support: int = 10
    least_lift: float = 1.0
    smoothing: float = 0.5


@dataclass(frozen=True)
class Mixture:
    """Target weights by domain. With ``anchor`` that domain's present tokens are
    its target and fix the others'; without, the targets share all tokens.
    Rates stay at most ``most_rate`` (none: unbounded above). Steps go on until a
    plain one would move rates by less than ``tolerance`` (root mean square over
    tokens)."""

    weights: dict[str, float] = field(default_factory=dict)
    anchor: str | None = None
    most_rate: float | None = None
    grid: int = 32
    tolerance: float = 1e-5

    def __post_init__(self):
        own = self.weights.values() if self.anchor is None else [self.weights.get(self.anchor, 0.0)]
        if min(self.weights.values(), default=0.0) < 0 or not sum(own) > 0:
            raise ValueError("weights are not negative, and their sum and that of the anchor are positive")


def quality_domain(quality: Column, toxic: Column) -> Column:
    """``toxic``, ``poor`` or ``good``; null without both labels."""
    known = quality.isNotNull() & toxic.isNotNull()
    return F.when(known, F.when(toxic == 1, "toxic").when(quality == 0, "poor").otherwise("good"))


def _tokens(documents: DataFrame) -> DataFrame:
    """``doc_id, copy, n_tokens, tokens``: distinct words; marks for the share, in
    tenths, of signs, of ASCII capitals and of bars; and the mark that every
    document has. The characters that count are cut out once."""
    text = F.coalesce("text", F.lit(""))
    words = documents.select(
        "doc_id", F.xxhash64("text").alias("copy"), F.greatest(F.length(text), F.lit(1)).alias("_size"),
        folded_words(text).alias("_words"), F.regexp_replace(text, f"[^{_SIGNS}A-Z]+", "").alias("_counted"),
    ).withColumn("_signs", F.regexp_replace("_counted", "[A-Z]+", ""))
    signs = F.length("_signs")
    counts = {
        "SIGNS": signs, "CAPITALS": F.length("_counted") - signs,
        "BARS": signs - F.length(F.replace(F.col("_signs"), F.lit("|"))),
    }
    # Upper case never occurs in folded words, so marks cannot equal one.
    shape = (F.concat(F.lit(name), F.ceil(count * 10 / F.col("_size")).cast("string")) for name, count in counts.items())
    return words.select(
        "doc_id", "copy", F.size("_words").cast("long").alias("n_tokens"),
        F.concat(F.array_distinct("_words"), F.array(*shape, F.lit("EVERY"))).alias("tokens"),
    )


def learn(documents: DataFrame, labels: DataFrame, domains: list[str], rule: Classifier = Classifier()) -> DataFrame:
    """``token, weights``: log odds of each domain if the token is there rather
    than not; ``EVERY`` has the priors and the odds of a document without any.
    ``labels``: ``doc_id, domain``."""
    usable = labels.filter(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull())
    chosen = (
        usable.groupBy("doc_id").agg(F.min("domain").alias("domain"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rule.most_labelled)
    )
    rows = documents.join(F.broadcast(chosen), "doc_id")
    counted = new_stage(
        _tokens(rows).join(F.broadcast(chosen), "doc_id")
        .groupBy("copy").agg(F.min(F.struct("doc_id", "domain", "tokens")).alias("row"))
        .select("row.domain", F.explode("row.tokens").alias("token"))
        .groupBy("token").agg(*(F.sum((F.col("domain") == name).cast("long")).alias(f"n{at}") for at, name in enumerate(domains))),
        "token_counts",
    )
    every = counted.rows.filter(F.col("token") == "EVERY").first()
    sizes = [every[f"n{at}"] if every else 0 for at in range(len(domains))]
    total = sum(sizes)
    held = sum(F.col(f"n{at}") for at in range(len(domains)))
    alpha = rule.smoothing

    def chance(at: int) -> Column:
        return (F.col(f"n{at}") + alpha) / (sizes[at] + 2 * alpha)

    def absent(at: int) -> Column:
        return F.log(1 - chance(at)) - F.log(1 - overall)

    def present(at: int) -> Column:
        return F.log(chance(at)) - F.log(overall) - absent(at)

    def deviation(at: int) -> Column:
        share = sizes[at] / max(total, 1)
        return F.abs(F.col(f"n{at}") - held * share) / F.sqrt(held * share * (1 - share) + 1e-9)

    overall = (held + alpha) / (total + 2 * alpha)
    places = range(len(domains))
    lift = F.greatest(*(F.log(chance(at)) - F.log(overall) for at in places), F.lit(0.0))
    chosen_tokens = (
        counted.rows.filter(F.col("token") != "EVERY")
        .withColumn("farthest", F.greatest(*map(deviation, places), F.lit(0.0)))
        .filter((F.col("farthest") >= rule.least_deviation) & (held >= rule.least_support) & (lift >= rule.least_lift))
        .orderBy(F.col("farthest").desc(), "token").limit(rule.most_features)
    )
    features = new_stage(
        chosen_tokens.select(
            "token", F.array(*map(present, places)).alias("weights"), F.array(*map(absent, places)).alias("absent")
        ),
        "features",
    )
    without = features.rows.agg(*(F.sum(F.get("absent", F.lit(at))) for at in places)).first()
    base = [
        math.log((size + alpha) / (total + alpha * len(domains))) + (rest or 0.0) for size, rest in zip(sizes, without)
    ]
    row = documents.sparkSession.createDataFrame([("EVERY", base)], "token string, weights array<double>")
    model = write_stage(features.rows.select("token", "weights").unionByName(row), "token_weights")
    features.remove()
    counted.remove()
    return model


def posteriors(documents: DataFrame, model: DataFrame, domains: list[str]) -> DataFrame:
    """``doc_id, copy, n_tokens, posterior`` (one number per domain). Words meet
    the model, which ``most_features`` bounds, where they are split; what is
    shuffled is one partial sum per document."""
    rows = _tokens(documents).select("doc_id", "copy", "n_tokens", F.explode("tokens").alias("token"))
    # Most words are not in the model, which a join on numbers tells faster than one on texts.
    numbers = model.select(F.xxhash64("token").alias("number"), F.col("token").alias("known"), "weights")
    met = rows.withColumn("number", F.xxhash64("token")).join(F.broadcast(numbers), "number").filter("token = known")
    repeats = F.sum((F.col("token") == "EVERY").cast("long"))
    sums = [F.sum(F.get("weights", F.lit(at))) for at in range(len(domains))]
    scored = met.groupBy("doc_id", "copy").agg(
        repeats.alias("_rows"), (F.max("n_tokens") * repeats).alias("n_tokens"),
        F.array(*(total / repeats for total in sums)).alias("_scores"),
    )
    shifted = scored.withColumn("_odds", F.transform("_scores", lambda score: F.exp(score - F.array_max("_scores"))))
    whole = F.aggregate("_odds", F.lit(0.0), lambda total, one: total + one)
    return shifted.withColumn("_whole", whole).select(
        "doc_id", "copy", "n_tokens", F.transform("_odds", lambda one: one / F.col("_whole")).alias("posterior")
    )


def _cell(posterior: Column, grid: int) -> Column:
    return F.transform(posterior, lambda share: F.round(share * grid).cast("int"))


def _cells(scored: DataFrame, size: int, grid: int) -> Stage:
    """``cell, n, mass``: tokens, and tokens by domain, of each grid cell."""
    masses = [F.sum(F.col("n_tokens") * F.get("posterior", F.lit(at))).alias(f"m{at}") for at in range(size)]
    summed = scored.groupBy(_cell(F.col("posterior"), grid).alias("cell")).agg(
        F.sum("n_tokens").cast("double").alias("n"), *masses
    )
    return new_stage(
        summed.filter(F.col("n") > 0).select("cell", "n", F.array(*(f"m{at}" for at in range(size))).alias("mass")), "cells"
    )


def _rates(history: list[tuple[list[float], float]], state: Column, step: float, most: float | None) -> Column:
    """``rate``, ``ahead`` (where the next gradient is taken) and ``moved`` of a cell
    after further steps, given as residuals by domain and momentum."""
    if not history:
        return state
    taken = F.array(*(
        F.struct(F.array(*map(F.lit, residual)).alias("residual"), F.lit(momentum).alias("momentum"))
        for residual, momentum in history
    ))

    def move(at: Column, by: Column) -> Column:
        pull = F.aggregate(
            F.zip_with("mass", by["residual"], lambda mass, rest: mass * rest), F.lit(0.0), lambda total, one: total + one
        )
        moved = F.greatest(at["ahead"] - pull / F.col("n") * step, F.lit(0.0))
        moved = moved if most is None else F.least(moved, F.lit(float(most)))
        return F.struct(
            moved.alias("rate"), (moved + by["momentum"] * (moved - at["rate"])).alias("ahead"), (moved - at["ahead"]).alias("moved")
        )

    return F.aggregate(taken, state, move)


def _step_size(cells: DataFrame, masses: list[Column], scale: list[float]) -> float:
    """Inverse of the largest curvature, from a matrix with one row per domain."""
    places = range(len(masses))
    products = [F.sum(masses[a] * masses[b] / F.col("n")).alias(f"h{a}_{b}") for a in places for b in places]
    bends = np.array([value or 0.0 for value in cells.agg(*products).first()]).reshape(len(masses), -1)
    curvature = float(np.linalg.eigvalsh(bends / np.sqrt(np.outer(scale, scale))).max(initial=0.0))
    return 1 / curvature if curvature else 0.0


# After this many steps the cells are written anew, so that no plan keeps growing.
_STEPS_HELD = 25


def fit_rates(scored: DataFrame, domains: list[str], mixture: Mixture) -> DataFrame:
    """``cell, rate`` by projected gradient least squares, with momentum that
    starts anew whenever the misses grow.

    Gradients are taken per token. A step is one sum over the cells; only two
    numbers per domain come to the driver.
    """
    cells = _cells(scored, len(domains), mixture.grid)
    places = range(len(domains))
    masses = [F.get("mass", F.lit(at)) for at in places]
    present = [value or 0.0 for value in cells.rows.agg(*map(F.sum, masses)).first()]
    scale = [max(tokens, 1.0) for tokens in present]
    weight = sum(mixture.weights.values())
    shares = [mixture.weights.get(name, 0.0) / weight for name in domains]
    budget = sum(present) if mixture.anchor is None else present[domains.index(mixture.anchor)] / shares[domains.index(mixture.anchor)]
    aims = [share * budget for share in shares]
    step = _step_size(cells.rows, masses, scale)
    first = 1.0 if mixture.most_rate is None else min(1.0, mixture.most_rate)
    current = new_stage(
        cells.rows.withColumn("state", F.struct(F.lit(first).alias("rate"), F.lit(first).alias("ahead"), F.lit(0.0).alias("moved"))),
        "rates",
    )
    history: list[tuple[list[float], float]] = []
    speed, last = 1.0, math.inf
    while step:
        state = _rates(history, F.col("state"), step, mixture.most_rate)
        row = current.rows.withColumn("now", state).agg(
            *(F.sum(mass * F.col("now.ahead")) for mass in masses), *(F.sum(mass * F.col("now.rate")) for mass in masses),
            F.sum(F.col("n") * F.col("now.moved") * F.col("now.moved")) / F.sum("n"),
        ).first()
        ahead, reached, moved = row[: len(domains)], row[len(domains) : -1], math.sqrt(row[-1])
        if (history or last < math.inf) and moved < mixture.tolerance:
            break
        error = sum((total - aim) ** 2 / tokens for total, aim, tokens in zip(reached, aims, scale))
        speed = 1.0 if error > last else speed
        following = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        residual = [(total - aim) / tokens for total, aim, tokens in zip(ahead, aims, scale)]
        history.append((residual, (speed - 1) / following))
        speed, last = following, error
        if len(history) == _STEPS_HELD:
            state = _rates(history, F.col("state"), step, mixture.most_rate)
            written = new_stage(current.rows.select("cell", "n", "mass", state.alias("state")), "rates")
            current.remove()
            current, history = written, []
    state = _rates(history, F.col("state"), step, mixture.most_rate)
    rates = write_stage(current.rows.select("cell", state["rate"].alias("rate")), "rates")
    current.remove()
    cells.remove()
    return rates


def rate_documents(
    documents: DataFrame, labels: DataFrame, mixture: Mixture, classifier: Classifier = Classifier()
) -> DataFrame:
    """``doc_id, copy, n_tokens, posterior, rate`` per document."""
    domains = sorted(mixture.weights)
    model = learn(documents, labels, domains, classifier)
    scored = write_stage(posteriors(documents, model, domains), "posteriors")
    rates = fit_rates(scored, domains, mixture)
    start = 1.0 if mixture.most_rate is None else min(1.0, mixture.most_rate)  # a cell without tokens
    return scored.withColumn("_cell", _cell(F.col("posterior"), mixture.grid)).join(
        F.broadcast(rates.withColumnRenamed("cell", "_cell")), "_cell", "left"
    ).select("doc_id", "copy", "n_tokens", "posterior", F.coalesce("rate", F.lit(start)).alias("rate"))


def mix_documents(
    documents: DataFrame, labels: DataFrame, mixture: Mixture, classifier: Classifier = Classifier()
) -> DataFrame:
    """The rows of ``documents`` drawn at their rates: ``floor(rate)`` times and
    once more with the rest as probability, decided by a hash of id and text."""
    rated = rate_documents(documents, labels, mixture, classifier)
    rated = rated.select(F.col("doc_id").alias("own_id"), F.col("copy").alias("own_copy"), "rate")
    rows = documents.select(F.struct(*(F.col(f"`{name}`") for name in documents.columns)).alias("row"), F.xxhash64("text").alias("copy"))
    chance = F.pmod(F.xxhash64(F.lit("draw"), F.col("own_id"), F.col("copy")), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.join(rated, F.col("row.doc_id").eqNullSafe(F.col("own_id")) & (F.col("copy") == F.col("own_copy")))
    times = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")
    kept = drawn.withColumn("times", times.cast("int")).filter(F.col("times") > 0)
    return kept.withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
