"""Benchmark passages in documents: a prefix-filtered join over word shingles.

An item is cut into windows of ten consecutive words; a shorter item is one
window. A window can only occur where all its five-word shingles do, so one
necessary shingle is enough to find it: the rarest one over all documents. Its
place in the window gives the only place the window can have; bounds on that
place come first, then the words themselves are compared.

Defined results. A-Z are lower-cased; ASCII letters, digits and all characters
beyond ASCII make words. Null and empty texts have none; items without words
have no windows. An item without an id makes words hit but is not listed. Rows
repeated under an id with one text have equal results. Extra columns are
ignored; texts are read whole; empty tables give no hits or no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailrisk.llm.common import CAPITALS, covered, same_row
from mailrisk.session import Stage, new_stage, write_stage

# ASCII characters that part words.
_PARTING = "".join(map(chr, (*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))))


@dataclass(frozen=True)
class Overlap:
    """Window and shingle length in words. Shingle hashes of all items are
    broadcast up to ``most_broadcast`` of them (8 bytes each) and otherwise
    joined by shuffling the documents' hashes."""

    window: int = 10
    shingle: int = 5
    most_broadcast: int = 4_000_000


def folded_words(text: Column) -> Column:
    """Words of the lower-cased text; one translation folds case and punctuation."""
    folded = F.translate(F.coalesce(text, F.lit("")), CAPITALS + _PARTING, CAPITALS.lower() + " " * len(_PARTING))
    return F.array_remove(F.split(folded, " "), "")


def _shingle(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *(F.get(words, at + ahead) for ahead in range(size)))


def _windows(benchmark: DataFrame, rule: Overlap) -> DataFrame:
    """``window, items, k``: distinct windows, their items and shingle length."""
    items = benchmark.select("item_id", folded_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (rule.window - 1), F.lit(1)))
    windows = items.select("item_id", "words", F.explode(starts).alias("start")).select(
        "item_id", F.slice("words", F.col("start"), F.lit(rule.window)).alias("window")
    )
    return windows.groupBy("window").agg(F.collect_set("item_id").alias("items")).withColumn(
        "k", F.least(F.size("window"), F.lit(rule.shingle))
    )


def _with_shingles(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """One row per shingle of a window: ``key`` and its ``offset``."""
    offsets = F.sequence(F.lit(0), F.size("window") - F.col("k"))
    placed = windows.withColumn("offset", F.explode(offsets))
    key = reduce(
        lambda other, size: F.when(F.col("k") == size, _shingle(F.col("window"), F.col("offset"), size)).otherwise(other),
        sizes, F.lit(None).cast("long"),
    )
    return placed.withColumn("key", key)


def _found(documents: DataFrame, keys: DataFrame, sizes: list[int], rule: Overlap) -> Stage:
    """Where documents hold a shingle of an item, with the words around it.

    One scan; positions, hashing and the join run in one generated loop and only
    matches leave it. With more shingles than may be broadcast, places and hashes
    alone are shuffled; the words of documents with matches follow by document.
    """
    rows = documents.select("doc_id", F.xxhash64("text").alias("copy"), folded_words(F.col("text")).alias("words"))
    sent = keys.count() <= rule.most_broadcast
    parts = []
    for size in sizes:
        at, back = F.col("at"), rule.window - size
        keyed = rows.select("doc_id", "copy", "words", F.posexplode("words").alias("at", "_word")).filter(
            at + size <= F.size("words")
        ).withColumn("key", _shingle(F.col("words"), at, size))
        if sent:
            matched = keyed.join(F.broadcast(keys), "key")
        else:
            places = keyed.select(F.col("doc_id").alias("own_id"), F.col("copy").alias("own_copy"), "at", "key").join(keys, "key")
            held = places.groupBy("own_id", "own_copy").agg(F.collect_set(F.struct("at", "key")).alias("places"))
            mine = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("copy") == F.col("own_copy"))
            matched = rows.join(held, mine).select("doc_id", "copy", "words", F.inline("places"))
        begin = F.greatest(at - back, F.lit(0))
        parts.append(
            matched.select(
                "doc_id", "copy", "key", "at", begin.alias("begin"),
                F.slice("words", begin + 1, at - begin + rule.window).alias("around"),
            )
        )
    return new_stage(reduce(DataFrame.unionByName, parts), "shingles")


def occurrences(documents: DataFrame, benchmark: DataFrame, rule: Overlap = Overlap()) -> DataFrame:
    """``doc_id, copy, start, end, items`` for every window found in a document;
    ``start`` and ``end`` count words, ``copy`` is a hash of the text."""
    windows = write_stage(_windows(benchmark, rule), "windows")
    sizes = sorted(row["k"] for row in windows.select("k").distinct().collect())  # at most rule.shingle values
    empty = "doc_id long, copy long, start long, end long, items array<long>"
    if not sizes:
        return documents.sparkSession.createDataFrame([], empty)
    shingles = write_stage(_with_shingles(windows, sizes), "item_shingles")
    found = _found(documents, shingles.select("key").distinct(), sizes, rule)
    frequency = found.rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    needed = (
        shingles.join(frequency, "key", "left")
        .groupBy("window", "items").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "key")).alias("rarest"))
        .filter(F.col("rarest.n") > 0)
        .select("window", "items", F.col("rarest.offset").alias("offset"), F.col("rarest.key").alias("key"))
    )
    start = F.col("at") - F.col("offset")
    inside = F.col("offset") - (F.col("at") - F.col("begin"))
    candidates = found.rows.join(needed, "key").filter(
        (inside <= 0) & (F.size("around") + inside >= F.size("window"))
    )
    same = F.slice("around", 1 - inside, F.size("window")) == F.col("window")
    result = write_stage(
        candidates.filter(same).select(
            "doc_id", "copy", start.cast("long").alias("start"),
            (start + F.size("window")).cast("long").alias("end"), "items",
        ),
        "occurrences",
    )
    found.remove()
    return result


def judge_documents(documents: DataFrame, benchmark: DataFrame, rule: Overlap = Overlap()) -> DataFrame:
    """``doc_id, copy, n_words, n_hit, items`` for every row; ``items`` are the
    ids as sorted strings."""
    found = occurrences(documents, benchmark, rule).groupBy("doc_id", "copy").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    hits = found.select(
        "doc_id", "copy", covered(F.col("spans")).alias("n_hit"),
        F.array_sort(F.transform("items", lambda item: item.cast("string"))).alias("items"),
    )
    rows = documents.select(
        "doc_id", F.xxhash64("text").alias("copy"), F.size(folded_words(F.col("text"))).cast("long").alias("n_words")
    )
    match = same_row(rows, hits, "doc_id") & (rows["copy"] == hits["copy"])
    return rows.join(hits, match, "left").select(
        rows["doc_id"], rows["copy"], "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame, rule: Overlap = Overlap()) -> DataFrame:
    """The rows of ``documents`` without an occurrence of any item window. The
    found documents are few and known by id and text hash."""
    found = occurrences(documents, benchmark, rule).select("doc_id", "copy").distinct()
    hit = documents["doc_id"].eqNullSafe(found["doc_id"]) & (F.xxhash64(documents["text"]) == found["copy"])
    return documents.join(found, hit, "left_anti")
