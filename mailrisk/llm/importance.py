"""Resampling documents towards a target table by hashed n-gram importance.

Every text is scanned for all its n-grams: separators are collapsed to single
spaces, and one regular expression per length, run with overlapping matches and
with lookarounds for the word boundaries, gives the spans of the n-grams, whose
bytes go to a CRC-32 bucket. Corpus and target are two distributions over the
buckets; a bucket's gain is the log of their ratio, smoothed by one, in
thousandths. A document's weight is the mean gain of its n-grams, and the
documents with the highest weight plus Gumbel noise are drawn: sampling without
replacement in proportion to the weights. The noise is a hash of the id, so a
draw can be repeated.

Texts are scanned once: the bucket numbers of a row, two bytes each, are written
next to it, and counts and weights are taken from those.

Defined results. Only A-Z is lower-cased, words are ASCII letters and digits and
all other characters beyond ASCII. Null and empty texts have no features, weight
zero, and are never drawn. A null id counts as an empty one and comes first among
equal scores. Rows repeated under an id are rows like others: all count, all may
be drawn, and take successive ranks. Extra columns are ignored. Without target
texts all buckets are compared with a flat distribution; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailrisk.llm.common import numbered, overall
from mailrisk.llm.hashing import chunks
from mailrisk.session import new_stage, ship_with_tasks, write_stage

ship_with_tasks(__name__)

# Separators become spaces and capitals small letters; all other bytes stay.
_FOLD = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A else 0x20
    for byte in range(256)
)
_GRID = 4294967296
_ROW_BITS = 33


@dataclass(frozen=True)
class Resampling:
    """``percent`` of the documents with at least ``least_words`` are drawn.
    ``buckets`` (65,536 at most) bounds what is gathered and sent to the tasks."""

    longest: int = 2
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"


def collapsed(text: bytes) -> bytes:
    """The words of a text, parted by single spaces."""
    return b" ".join(text.translate(_FOLD).split())


def gram_pattern(size: int):
    """Matches ``size`` whole words; overlapping matches start at every word."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (size - 1))


def gram_buckets(words: bytes, patterns: list, buckets: int) -> np.ndarray:
    """Bucket of every n-gram of collapsed words, repeats included."""
    crc32 = zlib.crc32
    found = (crc32(words[start:end]) for one in patterns for start, end in (m.span() for m in one.finditer(words, overlapped=True)))
    return (np.fromiter(found, np.int64) % buckets).astype(np.uint16)


def _features(table: DataFrame, rule: Resampling, name: str) -> DataFrame:
    """Written ``row, n_words, grams``, and ``doc_id`` where the table has one;
    ``row`` numbers the rows, ``grams`` are their buckets as two-byte numbers."""
    if rule.buckets > 1 << 16:
        raise ValueError("buckets are written as two bytes: 65,536 at most")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [gram_pattern(size) for size in range(1, rule.longest + 1)]
        row = TaskContext.get().partitionId() << _ROW_BITS
        for rows, texts in chunks(batches, "text"):
            words = [collapsed(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), pa.array(range(row, row + len(words)), pa.int64()),
                    pa.array([len(one) and one.count(b" ") + 1 for one in words], pa.int64()),
                    pa.array([gram_buckets(one, patterns, rule.buckets).tobytes() for one in words], pa.binary()),
                ],
                names=["doc_id", "row", "n_words", "grams"],
            )
            row += len(words)

    doc_id = F.col("doc_id").cast("long") if "doc_id" in table.columns else F.lit(None).cast("long")
    rows = table.select(doc_id.alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return write_stage(rows.mapInArrow(scan, "doc_id long, row long, n_words long, grams binary"), name)


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket: summed within tasks, then over them."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for grams in batch.column("grams"):
                total += np.bincount(np.frombuffer(grams.as_py(), np.uint16), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    summed = features.select("grams").mapInArrow(add, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in summed.collect():  # bounded by the number of buckets
        counts[bucket] = n
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to corpus, rounded down."""
    s_all, t_all, buckets = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def gumbel(seed: str, doc_id: int | None) -> int:
    """Noise of an id in thousandths, rounded down."""
    drawn = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / _GRID)))


def _scored(features: DataFrame, gains: np.ndarray, rule: Resampling) -> DataFrame:
    """``doc_id, row, n_words, n_features, weight, score``."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [np.frombuffer(one.as_py(), np.uint16) for one in batch.column("grams")]
            weights = [int(gains[one].sum()) // len(one) if len(one) else 0 for one in grams]
            noise = [gumbel(rule.seed, doc_id) for doc_id in batch.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row"), batch.column("n_words"),
                    pa.array([len(one) for one in grams], pa.int64()), pa.array(weights, pa.int64()),
                    pa.array([weight + own for weight, own in zip(weights, noise)], pa.int64()),
                ],
                names=["doc_id", "row", "n_words", "n_features", "weight", "score"],
            )

    schema = "doc_id long, row long, n_words long, n_features long, weight long, score long"
    return features.mapInArrow(score, schema)


def _cut(scores: DataFrame, wanted: int) -> int | None:
    """The ``wanted``-th highest score. Scores are whole numbers between the log
    bounds of gains and noise, some 100,000 values, which bounds what is gathered."""
    held = 0
    for score, n in sorted(scores.groupBy("score").count().collect(), reverse=True):
        held += n
        if wanted and held >= wanted:
            return score
    return None


def resample(documents: DataFrame, target: DataFrame, rule: Resampling = Resampling()) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of
    ``documents``; ``rank`` counts the drawn ones from 1 and is null for others.

    Only rows at or above the cut are sorted, by ranges; a rank is the number of
    rows in the ranges before plus the place inside its own.
    """
    own = _features(documents, rule, "grams")
    aimed = _features(target.select("text"), rule, "target-grams")
    gains = bucket_gains(bucket_counts(own, rule.buckets), bucket_counts(aimed, rule.buckets))
    scored = write_stage(_scored(own, gains, rule), "scored")
    fit = F.col("n_words") >= rule.least_words
    wanted = rule.percent * scored.filter(fit).count() // 100
    cut = _cut(scored.filter(fit), wanted)
    columns = ("doc_id", "n_words", "n_features", "weight", "score")
    if cut is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    high = fit & (F.col("score") >= cut)
    ordered = new_stage(numbered(scored.filter(high), F.desc("score"), "doc_id", "row"), "drawn").rows
    rank = F.col("_overall") + 1
    drawn = overall(ordered).select(*columns, F.when(rank <= wanted, rank).alias("rank"))
    return scored.filter(~high).select(*columns, F.lit(None).cast("long").alias("rank")).unionByName(drawn)
