"""Repeated passages: a count-min prefilter, then exact grouping of the windows it leaves.

A window is 50 consecutive words of one document. Every window contains 26 runs
of 25 words; the one with the smallest hash is its anchor, and equal windows have
equal anchors. Neighbouring windows mostly share theirs, so a sketch of anchors
is a dozen times smaller than one of windows, and an anchor's count is never
below that of any of its windows. The partitions' sketches are summed cell by
cell; only windows whose anchor is estimated to be repeated are grouped exactly.

Neighbouring windows with one anchor travel as one run, a row with a digest of
all its words. Equal runs are grouped first: in all documents but the one with
the smallest id every window of the run is repeated. What is left is one
document per distinct run, and a window of it can only be in an unequal run of
the same anchor; the windows of just these runs are then grouped one by one.

Defined results. Words are parted by white space and compared unchanged; null
texts have none. A document without an id loses nothing and takes nothing from
others. Rows repeated under one id do not count as repetitions. Texts shorter
than a window lose nothing. Extra columns are ignored; texts are read whole; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailrisk.llm.hashing import chunks, mix, word_hashes
from mailrisk.session import new_stage, ship_with_tasks, write_stage

ship_with_tasks(__name__)

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_BLOCK_BITS = 16
_COUNT_BITS = 20


@dataclass(frozen=True)
class Repeats:
    """Window length, windows in a run at most, and sketch size. A row of the sketch has the next power of
    two above ``cells_per_anchor`` times the anchors to be expected, at most
    ``2 ** most_bits`` cells; what is sent to the tasks is one bit per cell. A
    full sketch lets more windows through to the exact grouping, never fewer."""

    words: int = 50
    run: int = 64
    rows: int = 3
    cells_per_anchor: int = 8
    most_bits: int = 29


def _powers(base: int, count: int) -> np.ndarray:
    """``base`` to the powers from 0 on, modulo 2^64."""
    factors = np.full(count, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


def span_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of the values from each start to before its end, from prefix sums
    modulo 2^64: dividing by an odd base is multiplying by its inverse."""
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(base, len(hashes)))])
    return mix((prefix[ends] - prefix[starts]) * _powers(pow(base, -1, 1 << 64), len(prefix))[starts])


def run_hashes(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of the ``size`` values from each position on."""
    starts = np.arange(len(hashes) - size + 1)
    return span_hashes(hashes, starts, starts + size, base)


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of the ``size`` values from each position on, by doubling."""
    width = 1
    while 2 * width <= size:
        values, width = np.minimum(values[:-width], values[width:]), 2 * width
    rest = size - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(hashes: np.ndarray, size: int) -> np.ndarray:
    """Anchor of every window of one document."""
    half = size // 2
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    return sliding_minimum(run_hashes(hashes, half, _BASES[0]), size - half + 1)


def _cells(values: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(values + np.uint64((row + 1) * _BASES[1] & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(64 - bits)).astype(np.int64)


def _documents(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    split = [text.split() for text in texts]
    hashes = word_hashes([word for words in split for word in words])
    place = 0
    for words in split:
        yield words, hashes[place : place + len(words)]
        place += len(words)


def _filled(cells: DataFrame, rows: int, bits: int, name: str) -> list[np.ndarray]:
    """The distinct ``cell`` numbers of ``rows`` sketch rows as one bit array per
    row. Bits come to the driver as blocks of a number and size that ``bits`` fixes."""
    block = F.shiftright("cell", _BLOCK_BITS)
    places = F.sort_array(F.collect_list(F.col("cell").bitwiseAND((1 << _BLOCK_BITS) - 1).cast("int")))
    blocks = new_stage(cells.groupBy(block.alias("block")).agg(places.alias("places")), name)
    filled = [np.zeros(1 << max(0, bits - 3), np.uint8) for _ in range(rows)]
    for part in blocks.rows.toLocalIterator():
        row, at = part["block"] >> (bits - _BLOCK_BITS), part["block"] & ((1 << (bits - _BLOCK_BITS)) - 1)
        own = np.zeros(1 << _BLOCK_BITS, np.uint8)
        own[part["places"]] = 1
        size = 1 << (_BLOCK_BITS - 3)
        filled[row][at * size : (at + 1) * size] = np.packbits(own, bitorder="little")
    blocks.remove()
    return filled


def _room(values: int, rule: Repeats) -> int:
    """Cells per row for so many values, as a power of two."""
    return min(rule.most_bits, max(_BLOCK_BITS, (values * rule.cells_per_anchor - 1).bit_length()))


def sketch(documents: DataFrame, rule: Repeats) -> tuple[int, list[np.ndarray]]:
    """Cells counted twice or more, as one bit array per row.

    A task counts the distinct anchors of each of its documents in sparse
    arrays; Spark sums them by cell with map-side combining. A word takes six
    bytes, and about one in 13 positions begins an anchor.
    """
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _room(max(1, int(size) // (6 * (rule.words // 4 + 1))), rule)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches, "text"):
            found = [np.unique(anchors(hashes, rule.words)) for _, hashes in _documents(texts)]
            values = np.concatenate(found) if found else np.empty(0, np.uint64)
            cells = np.concatenate([(row << bits) | _cells(values, row, bits) for row in range(rule.rows)])
            cells, counts = np.unique(cells, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.minimum(counts, 2))], names=["cell", "n"])

    rows = documents.filter(F.col("doc_id").isNotNull()).select(F.col("text").cast("binary").alias("text"))
    repeated = (
        rows.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).filter(F.col("n") > 1)
    )
    return bits, _filled(repeated, rule.rows, bits, "sketch")


def _passes(values: np.ndarray, bits: int, filled: list[np.ndarray]) -> np.ndarray:
    kept = np.ones(len(values), bool)
    for row, cells in enumerate(filled):
        places = _cells(values, row, bits)
        kept &= (cells[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)
    return kept


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _runs(values: np.ndarray, rule: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of windows with equal anchors, in pieces of
    ``rule.run`` at most."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(values)))
    pieces = -(-sizes // rule.run)
    inside = (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * rule.run
    return np.repeat(starts, pieces) + inside, np.minimum(np.repeat(sizes, pieces) - inside, rule.run)


def _digests(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for the words of each span, as two signed numbers."""
    first, second = span_hashes(hashes, starts, ends, _BASES[0]), span_hashes(mix(hashes), starts, ends, _BASES[1])
    return (first + (ends - starts).astype(np.uint64)).view(np.int64), second.view(np.int64)


def _screened(documents: DataFrame, rule: Repeats) -> DataFrame:
    """``doc_id, n_words, kept_sha256`` of the whole text, and for documents with
    runs that pass the sketch the text and ``starts, sizes, anchors, first, second`` of these runs."""
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(sketch(documents, rule))

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, filled = sent.value
        for rows, texts in chunks(batches, "text"):
            columns: list[list] = [[] for _ in range(8)]
            for text, (words, hashes) in zip(texts, _documents(texts)):
                found = anchors(hashes, rule.words)
                starts, sizes = _runs(found, rule)
                passed = _passes(found[starts], bits, filled)
                starts, sizes = starts[passed], sizes[passed]
                values = [len(words), _digest(words), *[None] * 6]
                if len(starts):
                    first, second = _digests(hashes, starts, starts + sizes + rule.words - 1)
                    values[2:] = (
                        text, starts.astype(np.int32), sizes.astype(np.int32), found[starts].view(np.int64), first, second
                    )
                for column, value in zip(columns, values):
                    column.append(value)
            types = [pa.int64(), pa.string(), pa.binary(), *(pa.list_(kind) for kind in (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(column, kind) for column, kind in zip(columns, types))],
                names=["doc_id", "n_words", "kept_sha256", "text", "starts", "sizes", "anchors", "first", "second"],
            )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(
        screen,
        "doc_id long, n_words long, kept_sha256 string, text binary, starts array<int>, sizes array<int>, "
        "anchors array<long>, first array<long>, second array<long>",
    )


def _owned(first: np.ndarray, second: np.ndarray, doc_ids: np.ndarray) -> np.ndarray:
    """One value for a run in a document."""
    return mix(first.view(np.uint64) ^ mix(second.view(np.uint64) + doc_ids.astype(np.int64).view(np.uint64)))


def _open_windows(passed: DataFrame, opened: DataFrame, rule: Repeats) -> DataFrame:
    """``doc_id, copy, place, first, second`` of every window of the ``opened``
    runs (``home, first, second``) in their home documents. The runs go to the
    tasks as bits; a wrong bit adds windows, which are grouped like any other."""
    bits = _room(max(1, opened.count()), rule)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second, home = (np.asarray(batch.column(name)) for name in ("first", "second", "home"))
            yield pa.RecordBatch.from_arrays([pa.array(_cells(_owned(first, second, home), 0, bits))], names=["cell"])

    cells = opened.select("home", "first", "second").mapInArrow(mark, "cell long").distinct()
    sent = opened.sparkSession.sparkContext.broadcast(_filled(cells, 1, bits, "opened"))

    def hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                starts, sizes, first, second = (
                    np.asarray(batch.column(name)[at].values) for name in ("starts", "sizes", "first", "second")
                )
                wanted = _passes(_owned(first, second, np.full(len(first), doc_id, np.int64)), bits, sent.value)
                if not wanted.any():
                    continue
                starts, sizes = starts[wanted].astype(np.int64), sizes[wanted]
                places = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                hashes = word_hashes(batch.column("text")[at].as_py().split())
                first, second = _digests(hashes, places, places + rule.words)
                count = len(places)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, doc_id, np.int64)), pa.array(np.full(count, batch.column("copy")[at].as_py(), np.int64)),
                        pa.array(places.astype(np.int32)), pa.array(first), pa.array(second),
                    ],
                    names=["doc_id", "copy", "place", "first", "second"],
                )

    rows = passed.select("doc_id", _short("kept_sha256").alias("copy"), "text", "starts", "sizes", "first", "second")
    return rows.mapInArrow(hash_windows, "doc_id long, copy long, place int, first long, second long")


def _cut(rows: DataFrame, size: int) -> DataFrame:
    """Texts without the words that the windows of ``repeats`` (place and number) cover, packed
    in one number; the rows of a batch are worked on a few MB of text at a time."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches, "text"):
            removed, digests, left = [], [], []
            for text, repeats in zip(texts, rows.column("repeats")):
                words = text.split()
                change = np.zeros(len(words) + 1, np.int64)
                packed = np.asarray(repeats.values)
                places, counts = packed >> _COUNT_BITS, packed & ((1 << _COUNT_BITS) - 1)
                np.add.at(change, places, 1)
                np.add.at(change, places + counts + size - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                kept = [word for word, out in zip(words, gone.tolist()) if not out]
                removed.append(int(gone.sum()))
                digests.append(_digest(kept))
                left.append(b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("whole"), pa.array(removed, pa.int64()), pa.array(digests), pa.array(left)],
                names=["doc_id", "whole", "n_removed", "cut_sha256", "left"],
            )

    return rows.mapInArrow(cut, "doc_id long, whole string, n_removed long, cut_sha256 string, left string")


def _short(digest: str) -> Column:
    return F.xxhash64(digest)


def cut_documents(documents: DataFrame, rule: Repeats = Repeats()) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, left`` for every row. ``left``
    is the shortened text with single spaces, null where nothing was removed.

    Exact copies are settled by their digest first: all but the smallest id lose
    every word, and only that one's runs are grouped. Groups are minima with
    map-side combining, written before rows meet them in joins that adaptive
    execution can split, so a passage that a third of all documents share is no
    task's alone.
    """
    screened = write_stage(_screened(documents.select("doc_id", "text"), rule), "screened")
    first_copy = screened.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= rule.words)).groupBy("kept_sha256").agg(
        F.min("doc_id").alias("home"), F.max("doc_id").alias("last")
    )
    copied = new_stage(first_copy.filter(F.col("home") < F.col("last")).select("kept_sha256", "home"), "copied")
    passed = screened.filter(F.col("starts").isNotNull() & F.col("doc_id").isNotNull())
    # A run carries eight bytes of its text's digest, to tell rows of one id apart.
    runs = new_stage(
        passed.select("doc_id", "kept_sha256", "starts", "sizes", "anchors", "first", "second")
        .join(copied.rows, "kept_sha256", "left")
        .filter(F.col("home").isNull() | (F.col("home") == F.col("doc_id")))
        .select(
            "doc_id", _short("kept_sha256").alias("copy"),
            F.explode(F.arrays_zip("starts", "sizes", "anchors", "first", "second")).alias("run"),
        )
        .select("doc_id", "copy", "run.*"),
        "runs",
    )
    distinct = new_stage(
        runs.rows.groupBy("first", "second").agg(
            F.min("doc_id").alias("home"), F.max("doc_id").alias("last"), F.min("anchors").alias("anchor")
        ),
        "distinct-runs",
    )
    mixed = distinct.rows.groupBy("anchor").agg(F.min("home").alias("low"), F.max("home").alias("high"))
    opened = new_stage(
        distinct.rows.join(mixed.filter(F.col("low") < F.col("high")).select("anchor"), "anchor").select("home", "first", "second"),
        "opened-runs",
    )
    windows = new_stage(_open_windows(passed, opened.rows, rule), "windows")
    shared = new_stage(
        windows.rows.groupBy("first", "second").agg(F.min("doc_id").alias("home"), F.max("doc_id").alias("last"))
        .filter(F.col("home") < F.col("last")).select("first", "second", "home"),
        "shared-windows",
    )
    shared_runs = distinct.rows.filter(F.col("home") < F.col("last")).select("first", "second", "home")
    packed = F.shiftleft(F.col("place").cast("long"), _COUNT_BITS) + F.col("count")
    whole = runs.rows.join(shared_runs, ["first", "second"]).filter(F.col("home") < F.col("doc_id"))
    single = windows.rows.join(shared.rows, ["first", "second"]).filter(F.col("home") < F.col("doc_id"))
    repeats = (
        whole.select("doc_id", "copy", F.col("starts").alias("place"), F.col("sizes").alias("count"))
        .unionByName(single.select("doc_id", "copy", "place", F.lit(1).alias("count")))
        .groupBy("doc_id", "copy").agg(F.collect_list(packed).alias("repeats"))
    )
    texts = passed.select("doc_id", _short("kept_sha256").alias("copy"), F.col("kept_sha256").alias("whole"), "text")
    found = texts.join(repeats, ["doc_id", "copy"]).dropDuplicates(["doc_id", "whole"])
    shortened = write_stage(_cut(found, rule.words), "shortened")
    for stage in (runs, distinct, opened, windows, shared):
        stage.remove()
    nothing = hashlib.sha256(b"").hexdigest()
    later_copy = F.coalesce(F.col("home") < F.col("doc_id"), F.lit(False))
    result = (
        screened.select("doc_id", "n_words", "kept_sha256").join(copied.rows, "kept_sha256", "left")
        .join(
            shortened.withColumnRenamed("whole", "kept_sha256"), ["doc_id", "kept_sha256"], "left"
        )
    )
    return result.select(
        "doc_id", "n_words",
        F.when(later_copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(later_copy, nothing).otherwise(F.coalesce("cut_sha256", "kept_sha256")).alias("kept_sha256"),
        F.when(later_copy, "").otherwise(F.col("left")).alias("left"),
    )
