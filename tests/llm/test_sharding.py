from __future__ import annotations

import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from mailrisk.llm import sharding

SCHEMA = "doc_id long, text string, lang string, n_chars long, shard string"


def corpus(count=3000, seed=3):
    chance = random.Random(seed)
    rows = []
    for doc_id in range(count):
        size = int(chance.paretovariate(1.2) * 60)
        text = chance.choice("abcdé") * min(size, 4000) + str(doc_id if chance.random() < 0.8 else doc_id % 7)
        rows.append((doc_id, text, chance.choice(["en", "de", "fr", None]), len(text), "old"))
    rows += [(10_000 + at, "copy " * 40, "en", 200, "old") for at in range(count // 3)]
    rows += [(None, None, None, None, None), (None, "", "en", 0, None), (3, rows[3][1], rows[3][2], rows[3][3], "old")]
    return rows


def check(rows, result, shards, overhead=16):
    assert sorted(str(r.doc_id) for r in result) == sorted(str(row[0]) for row in rows)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in result:
        assert r.size == len((r.text or "").encode()) + overhead
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert set(slots) <= set(range(shards))
    return [sizes[at] for at in range(shards)]


def test_bytes_are_near_equal_and_slots_gapless(spark):
    rows = corpus()
    documents = spark.createDataFrame(rows, SCHEMA).repartition(6)
    for shards in (1, 7, 40):
        result = sharding.shard_documents(documents, shards=shards).collect()
        sizes = check(rows, result, shards)
        mean, largest = sum(sizes) / shards, max(len((row[1] or "").encode()) for row in rows)
        assert max(sizes) - min(sizes) <= 2 * largest + mean / 8
        homes = defaultdict(set)
        for r in result:
            homes[zlib.crc32((r.text or "").encode()), r.lang, r.n_chars].add(r.shard)
        copies = [own for own in homes.values() if len(own) > 1]
        assert len(copies) <= shards  # only groups too heavy for the balance


def test_target_bytes_small_and_empty_tables(spark):
    rows = corpus(200)
    documents = spark.createDataFrame(rows, SCHEMA)
    total = documents.agg(F.sum(sharding.text_size(F.col("text"), 16))).first()[0]
    result = sharding.shard_documents(documents, target_bytes=5000).collect()
    check(rows, result, -(-total // 5000))
    few = spark.createDataFrame(rows[:3], SCHEMA)
    check(rows[:3], sharding.shard_documents(few, shards=40).collect(), 40)
    assert sharding.shard_documents(documents.limit(0), shards=40).collect() == []


def test_blocks_number_shards_without_gaps(spark):
    rows = corpus(500)
    documents = spark.createDataFrame(rows, SCHEMA)
    balance = sharding.Balance(rows_per_block=10)
    check(rows, sharding.shard_documents(documents, shards=5, balance=balance).collect(), 5)


def test_codes_keep_order(spark):
    numbers = [None, 0, 1, 2, 3, 1000, 1001, 10**6, 10**12, 2**62]
    codes = [r[0] for r in spark.createDataFrame([(n,) for n in numbers], "n long").select(sharding.number_code(F.col("n"))).collect()]
    assert codes == sorted(codes) and codes[-1] < 1 << 24
    texts = [None, "", "a", "ab", "abc", "abd", "b", "é", "日本"]
    codes = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(sharding.text_code(F.col("t"))).collect()]
    assert codes == sorted(codes)
