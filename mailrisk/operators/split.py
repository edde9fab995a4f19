"""Exact stratified train/test split and balanced class weights.

Rows are ordered within their class by a seeded hash; the first ones form the
test side. The cut is located by counting hash prefixes, so no task ever sorts
a whole class, and the split itself is a plain filter without a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailrisk.sources.tables import class_counts

# Split settings.
SEED = 42
TEST_SIZE = 0.2

_PREFIX = 4  # hexadecimal digits: at most 65,536 buckets per class


def split_hash(seed: int = SEED) -> Column:
    return F.md5(F.concat(F.col("row_key").cast("string"), F.lit(f":{seed}")))


def test_quota(counts: dict[int, int], test_size: float = TEST_SIZE) -> dict[int, int]:
    """Test rows per class: proportional, rounded by largest remainder."""
    total = sum(counts.values())
    wanted = math.ceil(test_size * total)
    exact = {label: wanted * n / total for label, n in counts.items()}
    quota = {label: math.floor(share) for label, share in exact.items()}
    by_remainder = sorted(counts, key=lambda label: (quota[label] - exact[label], label))
    for label in by_remainder[: wanted - sum(quota.values())]:
        quota[label] += 1
    return quota


def _cut_points(mails: DataFrame, quota: dict[int, int], seed: int) -> dict[int, str]:
    """Hash of the last test row of every class."""
    hashed = mails.select("label", split_hash(seed).alias("hash"))
    prefix = F.substring("hash", 1, _PREFIX)
    buckets = hashed.groupBy("label", prefix.alias("prefix")).count()
    ordered = Window.partitionBy("label").orderBy("prefix")
    wanted = F.coalesce(*(F.when(F.col("label") == label, F.lit(n)) for label, n in quota.items()))
    edge = (
        buckets.withColumn("upto", F.sum("count").over(ordered))
        .where((F.col("upto") >= wanted) & (F.col("upto") - F.col("count") < wanted))
        .collect()
    )
    if not edge:
        return {}
    rank = {row["label"]: quota[row["label"]] - (row["upto"] - row["count"]) for row in edge}
    # About n / 65,536 rows per class are ranked one by one.
    inside = F.lit(False)
    for row in edge:
        inside = inside | ((F.col("label") == row["label"]) & (prefix == row["prefix"]))
    position = F.row_number().over(Window.partitionBy("label").orderBy("hash"))
    wanted_rank = F.coalesce(*(F.when(F.col("label") == l, F.lit(n)) for l, n in rank.items()))
    last = hashed.where(inside).withColumn("position", position)
    return {r["label"]: r["hash"] for r in last.where(F.col("position") == wanted_rank).collect()}


def stratified_split(
    mails: DataFrame, test_size: float = TEST_SIZE, seed: int = SEED
) -> DataFrame:
    """Append ``is_test``. ``row_key`` must be unique; three small jobs run."""
    quota = test_quota(class_counts(mails), test_size)
    cuts = _cut_points(mails, quota, seed)
    is_test = F.lit(False)
    for label, cut in cuts.items():
        is_test = is_test | ((F.col("label") == label) & (split_hash(seed) <= cut))
    return mails.withColumn("is_test", is_test)


def balanced_weights(counts: dict[int, int]) -> dict[int, float]:
    """Weight ``n / (2 * n_class)`` per class."""
    total = sum(counts.values())
    return {label: total / (len(counts) * n) for label, n in counts.items()}


def with_class_weight(mails: DataFrame, counts: dict[int, int]) -> DataFrame:
    weights = balanced_weights(counts)
    chosen = F.coalesce(
        *(F.when(F.col("label") == label, F.lit(weight)) for label, weight in weights.items())
    )
    return mails.withColumn("class_weight", chosen)
