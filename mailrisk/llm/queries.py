"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailrisk.llm import (
    chat, contamination, importance, licenses, minhash, mixing, quality, repair, secrets, sharding, simhash, substrings,
    tokens,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def judged_lines(spark: SparkSession, sf_dir: str, rules: quality.LineRules) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    names = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_lines", "n_removed_words",
    )
    return quality.judge_documents(documents, rules).select("doc_id", *(F.col(f"quality.{name}") for name in names))


@query
def op1_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_lines(spark, sf_dir, quality.LineRules())


@query
def op3_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secrets.scan_documents(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda span: span["kind"].isin(*secrets.BASE))

    def number(kind: str):
        return F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id", *(number(kind) for kind in secrets.BASE),
        F.sha2(secrets.span_list(base), 256).alias("base_sha256"), secrets.span_list(F.col("spans")).alias("spans"),
    )


@query
def op4_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], given.schema)
    formatted = chat.format_paths(chat.best_paths(chat.chains(given.unionByName(probe))))
    read = formatted.select(
        "tree", "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("mask")).alias("loss"),
    )
    said = F.array_join(F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "tokens.n_bytes", "tokens.n_tokens", "tokens.over_limit")


@query
def op6_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    grouped = minhash.group_documents(documents, minhash.Similarity(words=4, percent=80))
    return grouped.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.cut_documents(documents).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op8_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = contamination.judge_documents(documents, table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    sharded = sharding.shard_documents(
        documents.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")))), shards=40
    )
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        "doc_id", mixing.quality_domain(F.col("quality"), F.col("toxic")).alias("domain")
    )


@query
def op10_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixture = mixing.Mixture({"good": 0.9, "poor": 0.08, "toxic": 0.02})
    rated = mixing.rate_documents(
        table(spark, sf_dir, "documents").select("doc_id", "text"), domain_labels(spark, sf_dir), mixture
    )
    shares = (F.get("posterior", F.lit(at)).alias(f"p_{name}") for at, name in enumerate(sorted(mixture.weights)))
    return rated.select("doc_id", "n_tokens", *shares, "rate")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query
def op2_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = licenses.scan_documents(
        documents, licenses.default_templates(spark), licenses.Match(everywhere=True)
    )
    best = F.get("licenses", F.lit(0))
    names = F.array_sort(F.transform("licenses", lambda match: match["template_id"]))
    return scanned.select(
        "doc_id", "n_words", F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(names, ",").alias("licenses"), best["template_id"].alias("best_license"),
        F.round(best["coverage"], 6).alias("best_coverage"),
        best["start"].alias("best_start"), best["end"].alias("best_end"),
    )


@query
def op11_repaired_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    repaired, report = repair.repair_conversations(repair.damaged(conversations))
    found = report.join(repair.digests(repaired), "conv", "left")
    counts = (F.coalesce(name, F.lit(0)).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    named = conversations.select("conv_id", repair.conversation_key().alias("conv")).distinct()
    return named.join(found, "conv", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op12_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    grouped = simhash.group_documents(documents, simhash.Fingerprinting(words=3, distance=2))
    return grouped.select("doc_id", "fingerprint", "component_id")


@query
def op13_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = importance.resample(documents, table(spark, sf_dir, "benchmark"), importance.Resampling(longest=1))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
