"""Tokens, 1-2-grams, vocabulary selection and TF-IDF vectors.

Cleaning runs in native expressions. Vocabulary counts and vectors are made in Arrow
batches from word codes, so neither words nor word pairs are sorted as texts;
counting needs one shuffle on the term, vectorizing none at all.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailrisk.functions.text import bind, clean_text, with_placeholders
from mailrisk.session import new_stage, ship_with_tasks

# Vectorizer settings.
MIN_DOCUMENTS = 2
MAX_DOCUMENT_SHARE = 0.95
MAX_TERMS = 30_000

# Counts documents in the same pass as terms; no token is empty.
_EVERY_DOCUMENT = ""

# Text that is counted or weighed at a time, and rows sent on at a time.
_SLICE_BYTES = 8 << 20
_EMITTED_ROWS = 100_000

# Per byte: itself if a-z, else a blank, which is the last step of the cleaning.
_LETTER_OR_BLANK = np.full(256, ord(" "), dtype=np.uint8)
_LETTER_OR_BLANK[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)

ship_with_tasks(__name__)


def tokens(cleaned: Column) -> Column:
    """Words of at least two letters."""
    return F.filter(F.split(cleaned, " "), lambda word: F.length(word) >= 2)


def _with_bigrams(words: Column) -> Column:
    neighbours = F.zip_with(
        F.slice(words, 1, F.size(words) - 1),
        F.slice(words, 2, F.size(words) - 1),
        lambda left, right: F.concat_ws(" ", left, right),
    )
    return F.when(F.size(words) > 1, F.concat(words, neighbours)).otherwise(words)


def terms(text: Column) -> Column:
    """Array of the words and neighbouring word pairs of a raw text."""
    return bind(tokens(clean_text(text)), _with_bigrams)


def _run_lengths(ordered: Column) -> Column:
    """``(term, tf)`` structs of a sorted array."""
    size = F.size(ordered)
    starts = F.filter(
        F.sequence(F.lit(0), size - 1),
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )
    counted = bind(
        starts,
        lambda at: F.zip_with(
            at,
            F.concat(F.slice(at, 2, F.size(at)), F.array(size)),
            lambda start, end: F.struct(
                F.get(ordered, start).alias("term"), (end - start).cast("long").alias("tf")
            ),
        ),
    )
    return F.when(size > 0, counted)


def term_counts(text: Column) -> Column:
    """Array of ``(term, tf)`` per text; null for a text without terms."""
    return bind(F.sort_array(terms(text)), _run_lengths)


def postings(mails: DataFrame, keys: Sequence[str], text: str = "text_combined") -> DataFrame:
    """Long table ``keys, term, tf``.

    ``explode_outer`` on purpose: for a plain explode the optimizer infers a
    size filter and evaluates the whole cleaning expression a second time.
    """
    exploded = mails.select(*keys, F.explode_outer(term_counts(F.col(text))).alias("posting"))
    return exploded.select(*keys, "posting.term", "posting.tf").where(F.col("term").isNotNull())


def _letters(texts: pa.Array) -> pa.Array:
    """Texts with placeholders whose other bytes than letters are blanks."""
    _, offsets, data = texts.buffers()
    if data is None:
        return texts
    blanked = _LETTER_OR_BLANK[np.frombuffer(data, dtype=np.uint8)]
    return pa.Array.from_buffers(texts.type, len(texts), [None, offsets, pa.py_buffer(blanked)], offset=texts.offset)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring texts of some ``_SLICE_BYTES``, which bounds what a task holds."""
    if not len(texts):
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    bounds = [0, *(np.flatnonzero(np.diff(ends // _SLICE_BYTES)) + 1).tolist(), len(texts)]
    for start, end in zip(bounds, bounds[1:]):
        yield texts.slice(start, end - start)


def _coded_tokens(cleaned: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of the text and code of every token, in order, and the coded words."""
    pieces = pc.split_pattern(cleaned, " ")
    words = pc.list_flatten(pieces)
    kept = pc.greater_equal(pc.utf8_length(words), 2)
    coded = words.filter(kept).dictionary_encode()
    owner = pc.list_parent_indices(pieces).filter(kept)
    return owner.to_numpy(), coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _key_counts(owner: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their occurrences and their texts; ``owner`` ascends."""
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    entered = first.copy()
    entered[1:] |= owner[1:] != owner[:-1]
    starts = np.flatnonzero(first)
    upto = np.cumsum(np.append(0, entered))
    ends = np.append(starts[1:], len(keys))
    return keys[starts], ends - starts, upto[ends] - upto[starts]


def _count_terms(cleaned: pa.Array) -> pa.Table:
    """``term, total_tf, df`` of some cleaned texts, plus one row that counts them."""
    owner, codes, words = _coded_tokens(cleaned)
    same = owner[1:] == owner[:-1]
    pairs = codes[:-1][same] * len(words) + codes[1:][same]
    word, word_tf, word_df = _key_counts(owner, codes)
    pair, pair_tf, pair_df = _key_counts(owner[:-1][same], pairs)
    left, right = np.divmod(pair, max(len(words), 1))
    names = pc.binary_join_element_wise(words.take(pa.array(left)), words.take(pa.array(right)), " ")
    everyone = [len(cleaned)]
    columns = {
        "term": pa.concat_arrays([pa.array([_EVERY_DOCUMENT], words.type), words.take(pa.array(word)), names]),
        "total_tf": pa.array(np.concatenate([everyone, word_tf, pair_tf]), pa.int64()),
        "df": pa.array(np.concatenate([everyone, word_df, pair_df]), pa.int64()),
    }
    return pa.table(columns)


def term_statistics(mails: DataFrame, text: str = "text_combined", by: str | None = None) -> DataFrame:
    """``term, total_tf, df`` over all mails, plus one row that counts the mails;
    with ``by``, the same per value of that column.

    Counted per slice of texts on word codes, then moved to the term's partition
    before they are added up: no task holds the terms of all its texts.
    """
    keys = [by] if by else []
    schema = T.StructType(
        [mails.schema[name] for name in keys]
        + [T.StructField("term", T.StringType()), T.StructField("total_tf", T.LongType()), T.StructField("df", T.LongType())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cleaned = _letters(batch.column("_text"))
            parts = [((), cleaned)]
            if keys:
                coded = batch.column(keys[0]).dictionary_encode(null_encoding="encode")
                parts = [
                    ((coded.dictionary.slice(code, 1),), cleaned.filter(pc.equal(coded.indices, code)))
                    for code in range(len(coded.dictionary))
                ]
            for value, texts in parts:
                for some in _slices(texts):
                    counted = _count_terms(some)
                    zeros = pa.array(np.zeros(len(counted), dtype=np.int64))
                    columns = [one.take(zeros) for one in value] + counted.combine_chunks().columns
                    yield from pa.table(columns, names=[*keys, "term", "total_tf", "df"]).to_batches(_EMITTED_ROWS)

    cleaned = mails.select(*keys, with_placeholders(F.col(text)).alias("_text"))
    return (
        cleaned.mapInArrow(count, schema)
        .repartition("term")
        .groupBy(*keys, "term")
        .agg(F.sum("total_tf").alias("total_tf"), F.sum("df").alias("df"))
    )


def smallest_kept_total(statistics: DataFrame, limit: int) -> int:
    """Total count of the ``limit``-th most frequent term (0 if there are fewer).

    Found on the histogram of totals, which has at most sqrt(2 * all tokens)
    rows, so the final top-``limit`` sort only sees terms at or above the cut.
    """
    histogram = statistics.groupBy("total_tf").agg(F.count(F.lit(1)).alias("terms"))
    running = F.sum("terms").over(Window.orderBy(F.desc("total_tf")))
    cut = (
        histogram.withColumn("running", running)
        .where(F.col("running") >= limit)
        .agg(F.max("total_tf").alias("cut"))
        .first()["cut"]
    )
    return cut or 0


@dataclass(frozen=True)
class TermModel:
    """A fitted vocabulary; the position of a term is its ``term_id``."""

    terms: list[str]
    total_tf: list[int]
    df: list[int]
    n_documents: int
    _cache: dict = field(default_factory=dict, compare=False, repr=False)

    @property
    def size(self) -> int:
        return len(self.terms)

    @property
    def idf(self) -> list[float]:
        """Smooth inverse document frequency."""
        return [math.log((1 + self.n_documents) / (1 + df)) + 1.0 for df in self.df]

    def arrow(self) -> pa.Table:
        columns = {
            "term_id": pa.array(range(self.size), pa.int32()),
            "term": pa.array(self.terms, pa.string()),
            "total_tf": pa.array(self.total_tf, pa.int64()),
            "df": pa.array(self.df, pa.int64()),
            "idf": pa.array(self.idf, pa.float64()),
        }
        return pa.table(columns)

    def table(self, spark: SparkSession) -> DataFrame:
        """``term_id, term, total_tf, df, idf``; at most ``MAX_TERMS`` rows."""
        return spark.createDataFrame(self.arrow())

    def vectorize(self, mails: DataFrame, text: str = "text_combined") -> DataFrame:
        """Append ``indices`` and ``weights``: sublinear TF-IDF, unit or zero length."""
        kept = mails.columns
        if not self.terms:
            return mails.select(
                *kept,
                F.array().cast("array<int>").alias("indices"),
                F.array().cast("array<double>").alias("weights"),
            )
        if "weigh" not in self._cache:
            self._cache["weigh"] = F.arrow_udf(
                _weigher(self.terms, self.idf), "struct<indices:array<int>,weights:array<double>>"
            )
        vector = self._cache["weigh"](with_placeholders(F.col(text)))
        return mails.withColumn("_vector", vector).select(
            *kept, F.col("_vector.indices").alias("indices"), F.col("_vector.weights").alias("weights")
        )


def _weigher(terms: list[str], idf: list[float]):
    """Function from texts with placeholders to their vectors.

    A word pair is looked up by the numbers of its words, so no pair is built as text.
    """
    parts = [term.split(" ") for term in terms]
    words = sorted({word for term in parts for word in term})
    number = {word: i for i, word in enumerate(words)}
    # The last place answers for words that occur in no term.
    single = np.full(len(words) + 1, -1, dtype=np.int64)
    pairs = []
    for term_id, term in enumerate(parts):
        if len(term) == 1:
            single[number[term[0]]] = term_id
        elif len(term) == 2:
            pairs.append((number[term[0]] * len(words) + number[term[1]], term_id))
    pairs.sort()
    pair_keys = np.array([key for key, _ in pairs], dtype=np.int64)
    pair_ids = np.array([term_id for _, term_id in pairs], dtype=np.int64)
    factors = np.array(idf)
    known = pa.array(words, pa.string())

    def weigh_some(cleaned: pa.Array) -> pa.Array:
        owner, codes, found = _coded_tokens(cleaned)
        ids = pc.fill_null(pc.index_in(found, value_set=known.cast(found.type)), -1).to_numpy(zero_copy_only=False)
        word = ids.astype(np.int64)[codes]
        term = single[word]
        near = (owner[1:] == owner[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0)
        keys = word[:-1][near] * len(words) + word[1:][near]
        place = np.searchsorted(pair_keys, keys)
        hit = np.append(pair_keys, -1)[place] == keys
        entries = np.concatenate([
            (owner.astype(np.int64) * len(factors) + term)[term >= 0],
            owner[:-1][near][hit].astype(np.int64) * len(factors) + pair_ids[place[hit]],
        ])
        entries, tf = np.unique(entries, return_counts=True)
        text, term = np.divmod(entries, len(factors))
        raw = (1.0 + np.log(tf)) * factors[term]
        norm = np.sqrt(np.bincount(text, raw * raw, minlength=len(cleaned)))
        offsets = pa.array(np.searchsorted(text, np.arange(len(cleaned) + 1)), pa.int32())
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(raw / norm[text], pa.float64())),
            ],
            ["indices", "weights"],
        )

    def weigh(texts: pa.Array) -> pa.Array:
        cleaned = _letters(texts)
        # A batch without rows still has to return its type.
        return pa.concat_arrays([weigh_some(some) for some in _slices(cleaned)] or [weigh_some(cleaned)])

    return weigh


def literal_array(values: Sequence[float], kind: str = "double") -> Column:
    """A constant array column (bounded by the vocabulary) as one literal."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def fit_terms(
    mails: DataFrame,
    text: str = "text_combined",
    min_documents: int = MIN_DOCUMENTS,
    max_share: float = MAX_DOCUMENT_SHARE,
    max_terms: int = MAX_TERMS,
) -> TermModel:
    """Select the vocabulary; ties in the frequency cut go to the smaller term."""
    counted = term_statistics(mails, text)
    # Most terms occur in one mail; they are not written.
    stage = new_stage(
        counted.where((F.col("term") == _EVERY_DOCUMENT) | (F.col("df") >= min_documents)), "term-statistics"
    )
    statistics = stage.rows
    try:
        everyone = statistics.where(F.col("term") == _EVERY_DOCUMENT).first()
        n_documents = everyone["df"] if everyone else 0
        usable = statistics.where(
            (F.col("term") != _EVERY_DOCUMENT)
            & (F.col("df") >= min_documents)
            & (F.col("df") <= max_share * n_documents)
        )
        cut = smallest_kept_total(usable, max_terms)
        kept = (
            usable.where(F.col("total_tf") >= cut)
            .orderBy(F.desc("total_tf"), "term")
            .limit(max_terms)
            .toArrow()
        )
    finally:
        stage.remove()
    kept = kept.sort_by("term")
    return TermModel(
        kept["term"].to_pylist(), kept["total_tf"].to_pylist(), kept["df"].to_pylist(), n_documents
    )


def long_weights(vectors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long form ``keys, term_id, weight`` of vectorized mails."""
    pairs = F.arrays_zip(F.col("indices").alias("term_id"), F.col("weights").alias("weight"))
    exploded = vectors.select(*keys, F.explode_outer(pairs).alias("entry"))
    return exploded.select(
        *keys, F.col("entry.term_id").alias("term_id"), F.col("entry.weight").alias("weight")
    ).where(F.col("term_id").isNotNull())
