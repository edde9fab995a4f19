"""Columns of the user's own whose names the operators use inside."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest

from mailrisk.llm import contamination, minhash, quality, tokens

NAMES = (
    "_size", "_minor", "_node", "_block", "_place", "_at", "_rate", "_copy", "_id", "_row", "_rows", "_text", "_text_of", "_host",
    "_own", "_own_id", "_own_copy", "_told", "_words", "_lines", "_over", "_raw", "_kept", "_signs", "_counted", "_cell", "_range",
    "_times", "_draw", "_key_bytes", "_hits", "quality", "tokens", "row", "given", "host", "copy", "rate", "at", "mark", "hub", "key",
    "own_id", "own_copy", "times", "draw", "left", "kept", "start", "end", "items", "words", "n_words", "digest", "places", "around",
    "window", "bands", "posterior", "component_id", "fingerprint", "node", "low", "bucket", "domain", "weights", "label",
)
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(*row, *(f"{name} {row.doc_id}" for name in NAMES)) for row in given.collect()]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in given.schema), *(f"{name} string" for name in NAMES)])
    return spark.createDataFrame(rows, schema).repartition(4)


def own(rows, names=NAMES):
    return all(row[name] == f"{name} {row.doc_id}" for row in rows for name in names)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_pass_them_through(spark, documents, name, stage):
    result = stage(spark, documents, SF_DIR)
    rows = result.collect()
    assert result.columns[: len(documents.columns)] == documents.columns and rows and own(rows)
    assert result.columns[len(documents.columns) :] == (["size", "shard", "slot"] if name == "sharding" else [])


def test_their_own_result_replaces_one_of_the_name(documents):
    judged = quality.judge_documents(documents)
    assert judged.columns.count("quality") == 1 and own(judged.collect(), [name for name in NAMES if name != "quality"])
    counted = tokens.count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"))
    assert counted.columns.count("tokens") == 1 and own(counted.collect(), [name for name in NAMES if name != "tokens"])


def test_others_ignore_them(spark, documents):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert contamination.judge_documents(documents, benchmark).count() == documents.count()
    assert minhash.group_documents(documents).count() == documents.count()
