"""The corpus pipeline: five operators, each over all that the one before it kept.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailrisk.llm import contamination, minhash, mixing, quality, sharding
from mailrisk.session import write_stage

SHARDS = 40
#: Good documents keep their tokens; poor and toxic ones are mixed down to nothing.
MIXTURE = mixing.Mixture({"good": 1.0, "poor": 0.0, "toxic": 0.0}, anchor="good", most_rate=1.0)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without lines too common on their host."""
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item."""
    return contamination.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at rates that leave the good domain whole."""
    labels = _table(spark, sf_dir, "labels").select(
        "doc_id", mixing.quality_domain(F.col("quality"), F.col("toxic")).alias("domain")
    )
    return mixing.mix_documents(docs, labels, MIXTURE)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their place in it."""
    return sharding.shard_documents(docs, shards=SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing_weights", mixing_weights),
    ("sharding", shards),
]

#: Signatures, posteriors and the tree are iterative; the tests hold every stage
#: against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
