"""Registered corpus queries, and the pipeline stage by stage, on the smallest tables."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import brute
import corpus_pipeline
import public_tokenizers
import pytest
import tokenizers

from mailrisk.llm.checks import ORACLES
from mailrisk.llm.queries import QUERIES
from mailrisk.session import write_stage
from workload.check import difference, duck

SF_DIR = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    with duck(SF_DIR) as connection:
        assert difference(QUERIES[name](spark, SF_DIR).toArrow(), connection.sql(ORACLES[name]).to_arrow_table()) is None


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


def test_near_duplicate_query(spark, documents):
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op6_super_minhash"](spark, SF_DIR).collect()}
    assert found == brute.near_groups([(r.doc_id, r.text) for r in documents], 4)


def test_repeated_passage_query(spark, documents):
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op7_repeated_passages"](spark, SF_DIR).collect()}
    assert found == brute.cut_repeats([(r.doc_id, r.text) for r in documents], 50)


def test_token_query_counts_as_the_library_does(spark, documents):
    library = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    library.no_truncation()
    library.no_padding()
    expected = {}
    for row in documents:
        n_tokens = len(library.encode(row.text or "", add_special_tokens=False).ids)
        expected[row.doc_id] = (len((row.text or "").encode()), n_tokens, n_tokens > 2048)
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op5_token_counts"](spark, SF_DIR).collect()}
    assert found == expected


def near_equal(rows, sizes):
    """Gapless slots, and bytes by shard no further apart than two texts, as ties and the largest texts allow."""
    slots, weights = defaultdict(list), Counter()
    for row in rows:
        slots[row.shard].append(row.slot)
        weights[row.shard] += sizes[row.doc_id]
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    mean = sum(sizes.values()) / corpus_pipeline.SHARDS
    assert max(weights.values()) <= mean + 2 * max(sizes.values())
    ordinary = sorted(weights.values())[4:-4]
    assert max(ordinary) <= 2 * min(ordinary) + 2 * sorted(sizes.values())[-len(sizes) // 10]


def test_shard_query_keeps_the_law(spark, documents):
    rows = QUERIES["op9_kd_shards"](spark, SF_DIR).collect()
    sizes = {r.doc_id: len((r.text or "").encode()) + 16 for r in documents}
    assert {r.doc_id: r.size for r in rows} == sizes and {r.shard for r in rows} <= set(range(40))
    assert {r.doc_id: r.text_crc32 for r in rows} == {r.doc_id: zlib.crc32((r.text or "").encode()) for r in documents}
    near_equal(rows, sizes)


def test_mixing_query_reaches_its_targets(spark):
    rows = QUERIES["op10_soft_mixing"](spark, LARGER).collect()
    documents = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text").collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {
        r.doc_id: len(brute.FOLDED.findall((r.text or "").translate(brute.LOWER))) for r in documents
    }
    shares = ("p_good", "p_poor", "p_toxic")
    masses = [sum(r[name] * r.n_tokens * r.rate for r in rows) for name in shares]
    total = sum(r.n_tokens for r in rows)
    assert all(abs(mass - share * total) <= 0.01 * total for mass, share in zip(masses, (0.9, 0.08, 0.02)))


def test_mixing_stage_keeps_the_good_and_drops_the_others(spark):
    documents = spark.read.parquet(f"{LARGER}/documents.parquet")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["mixing_weights"](spark, documents, LARGER).collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    good = {doc_id for doc_id, label in labels.items() if label.quality == 1 and label.toxic == 0}
    toxic = {doc_id for doc_id, label in labels.items() if label.toxic == 1}
    assert len(good & kept) >= 0.97 * len(good) and len(toxic & kept) <= 0.5 * len(toxic)


def test_every_stage_against_plain_versions(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "mixing_weights", "sharding",
    ]
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = brute.quality([(r.doc_id, r.text, r.source) for r in documents])
    docs = write_stage(stages["quality_rules"](spark, given, SF_DIR), "test")
    assert docs.columns == given.columns
    assert {r.doc_id for r in docs.collect()} == {doc_id for doc_id, measures in expected.items() if measures[6]}

    groups = brute.near_groups([(r.doc_id, r.text) for r in docs.collect()], 5)
    docs = write_stage(stages["near_duplicates"](spark, docs, SF_DIR), "test")
    assert docs.columns == given.columns
    assert sorted(r.doc_id for r in docs.collect()) == sorted(doc_id for doc_id, (_, _, kept) in groups.items() if kept)

    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute.contaminated([(r.doc_id, r.text) for r in docs.collect()], items)
    docs = write_stage(stages["decontamination"](spark, docs, SF_DIR), "test")
    assert sorted(r.doc_id for r in docs.collect()) == sorted(doc_id for doc_id, (_, hit, _) in hits.items() if not hit)

    mixed = write_stage(stages["mixing_weights"](spark, docs, SF_DIR), "test")
    assert mixed.columns == given.columns
    before, after = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in mixed.collect()}
    assert after.items() <= before.items() and mixed.count() == len(after)

    sharded = stages["sharding"](spark, mixed, SF_DIR).collect()
    assert {r.doc_id: r.text for r in sharded} == after and {r.shard for r in sharded} <= set(range(corpus_pipeline.SHARDS))
    near_equal(sharded, {doc_id: len((text or "").encode()) + 16 for doc_id, text in after.items()})


def test_empty_documents_go_through_every_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = write_stage(stage(spark, docs, SF_DIR), name)
        assert docs.count() == 0
