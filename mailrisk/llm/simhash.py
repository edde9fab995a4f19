"""SimHash near-duplicates: fingerprints joined with themselves in a binary trie.

A fingerprint bit is set where over half of a text's shingle hashes have it.
Fingerprints are the paths of a binary trie. The join walks pairs of trie nodes
of one depth together, starting with the root and itself: a step goes to the
two by two children, adds one error where their bits differ, and leaves a pair
as soon as its errors exceed the budget. What is left at the leaves are all pairs
within the distance, nothing else.

The upper levels are walked by all tasks at once: every fingerprint names the
node pairs it reaches at some depth, and a node pair is the unit of work that
is shuffled. The depth follows from the number of distinct fingerprints, and a
node pair that is still too large is walked further down until it fits, so a
task holds a bounded number of fingerprints whatever the data look like. Inside
a unit the walk goes on depth first over bounded arrays of node pairs.

Defined results. Words are parted by white space, A-Z lower-cased. A text with
fewer words than a shingle is one shingle; null, empty and blank texts have the
fingerprint zero, which links like any other. Every row gets a result: rows
repeated under an id are rows of one class if their texts are equal. Rows without
an id link like others, but name a component only where no id is in reach (null
then). Extra columns are ignored. Texts are read whole; an empty table gives no
rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailrisk.llm.components import components
from mailrisk.llm.hashing import chunks
from mailrisk.session import Stage, new_stage, ship_with_tasks, write_stage

ship_with_tasks(__name__)

BITS = 64
SEED = 42
# Fingerprints per trie node aimed at, and most rows of a unit of work.
_NODE_KEYS = 4_096
_UNIT_ROWS = 65_536
_MORE_BITS = 4
# Shingle hashes whose bits are counted at once; node pairs walked at once;
# comparisons by which a small pair of nodes is settled at once.
_SOME_HASHES = 1 << 16
_SOME_PAIRS = 1 << 18
_FEW_COMPARISONS = 16
_UNIT = ("left", "right", "depth")


@dataclass(frozen=True)
class Fingerprinting:
    """Words per shingle and the most bits in which linked fingerprints differ."""

    words: int = 5
    distance: int = 2


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of all shingles of a text, repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[size - 1 :].tolist() or [len(joined)]
    return np.fromiter(
        (xxhash.xxh64_intdigest(joined[start:end], SEED) for start, end in zip(starts, ends)), np.uint64, len(ends)
    )


def fingerprints(texts: list[bytes], size: int) -> np.ndarray:
    """One fingerprint per text."""
    hashes = [shingle_hashes(text, size) for text in texts]
    lengths = np.array([len(one) for one in hashes], np.int64)
    owners, flat = np.repeat(np.arange(len(texts)), lengths), np.concatenate([np.empty(0, np.uint64), *hashes])
    counts = np.zeros((len(texts), BITS), np.int64)
    for start in range(0, len(flat), _SOME_HASHES):
        part, owner = flat[start : start + _SOME_HASHES], owners[start : start + _SOME_HASHES]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        counts[owner[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > lengths[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _signed(documents: DataFrame, rule: Fingerprinting) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("copy"), pa.array(fingerprints(texts, rule.words).view(np.int64))],
                names=["doc_id", "copy", "key"],
            )

    rows = documents.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("copy"), F.col("text").cast("binary").alias("text")
    )
    return rows.mapInArrow(sign, "doc_id long, copy long, key long")


def masks(bits: int, errors: int) -> np.ndarray:
    """All numbers of ``bits`` bits with at most ``errors`` set."""
    found = [0]
    for _ in range(min(errors, bits)):
        found += [mask | 1 << bit for mask in found for bit in range(bits)]
    return np.unique(np.array(found, np.uint64))


def _descend(rows: DataFrame, bits: int, distance: int) -> DataFrame:
    """Rows ``left, right, depth, key`` of node pairs, ``bits`` levels further down.

    A fingerprint goes to the pairs of its own descendant with every descendant
    of the other node that the errors left still allow.
    """
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, key = (batch.column(name).to_numpy().view(np.uint64) for name in ("left", "right", "key"))
            depth = batch.column("depth").to_numpy().astype(np.uint64)
            down = np.minimum(np.uint64(bits), np.uint64(BITS) - depth)
            own = key >> (np.uint64(BITS) - depth - down)
            on_left = own >> down == left
            other, low = np.where(on_left, right, left) << down, own & ((np.uint64(1) << down) - np.uint64(1))
            spare = distance - np.bitwise_count(left ^ right).astype(np.int64)
            for mask in masks(bits, distance):
                goes = (np.bitwise_count(mask) <= spare) & (mask >> down == 0)
                node = (other | (low ^ mask))[goes]
                mine = own[goes]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.minimum(mine, node).view(np.int64)), pa.array(np.maximum(mine, node).view(np.int64)),
                        pa.array((depth + down)[goes].astype(np.int32)), pa.array(key[goes].view(np.int64)),
                    ],
                    names=[*_UNIT, "key"],
                )

    return rows.mapInArrow(walk, "left long, right long, depth int, key long")


def _units(keys: DataFrame, distance: int) -> Stage:
    """Written ``left, right, depth, key``: every node pair within the budget, with
    the fingerprints below its nodes; no pair has more rows than a unit may hold."""
    bits = max(0, math.ceil(math.log2(max(keys.count(), 1) / _NODE_KEYS)))
    root = keys.select(F.lit(0).cast("long").alias("left"), F.lit(0).cast("long").alias("right"), F.lit(0).alias("depth"), "key")
    units = new_stage(_descend(root, bits, distance) if bits else root, "simhash-units")
    while True:
        large = new_stage(
            units.rows.groupBy(*_UNIT).count().filter((F.col("count") > _UNIT_ROWS) & (F.col("depth") < BITS)).select(*_UNIT),
            "simhash-large",
        )
        if large.rows.isEmpty():
            large.remove()
            return units
        deeper = _descend(units.rows.join(large.rows, list(_UNIT), "left_semi"), _MORE_BITS, distance)
        following = new_stage(units.rows.join(large.rows, list(_UNIT), "left_anti").unionByName(deeper), "simhash-units")
        units.remove()
        large.remove()
        units = following


def _settle(left: np.ndarray, right: np.ndarray, pairs: np.ndarray, distance: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the fingerprints within the distance, below small node pairs."""
    n_left, n_right = pairs[1] - pairs[0], pairs[3] - pairs[2]
    sizes = n_left * n_right
    which = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    i, j = pairs[0][which] + at // n_right[which], pairs[2][which] + at % n_right[which]
    near = np.bitwise_count(left[i] ^ right[j]) <= distance
    if same:
        near &= i < j
    return i[near], j[near]


def close_pairs(left: np.ndarray, right: np.ndarray, depth: int, distance: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of sorted fingerprints within the distance.

    ``left`` and ``right`` lie below one trie node each, of the given depth;
    with ``same`` they are one list, and a pair is given once. A node is a
    range of its list. An array of node pairs has the rows left start, left end,
    right start, right end, errors so far.
    """
    errors = 0 if same or not depth else int(np.bitwise_count((left[0] ^ right[0]) >> np.uint64(BITS - depth)))
    waiting = [(depth, np.array([[0], [len(left)], [0], [len(right)], [errors]]))]
    while waiting:
        depth, pairs = waiting.pop()
        if pairs.shape[1] > _SOME_PAIRS:
            half = pairs.shape[1] // 2
            waiting += [(depth, pairs[:, :half]), (depth, pairs[:, half:])]
            continue
        small = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2]) <= _FEW_COMPARISONS
        yield _settle(left, right, pairs[:, small], distance, same)
        pairs = pairs[:, ~small]
        if not pairs.shape[1]:
            continue
        bit = np.uint64(1 << (BITS - 1 - depth))
        above = ~(bit | (bit - np.uint64(1)))
        left_middle = np.searchsorted(left, (left[pairs[0]] & above) | bit)
        right_middle = np.searchsorted(right, (right[pairs[2]] & above) | bit)
        own = same & (pairs[0] == pairs[2])  # a node with itself: its two children are paired once
        children = []
        for one, (left_start, left_end) in enumerate(((pairs[0], left_middle), (left_middle, pairs[1]))):
            for two, (right_start, right_end) in enumerate(((pairs[2], right_middle), (right_middle, pairs[3]))):
                below = np.stack([left_start, left_end, right_start, right_end, pairs[4] + (one != two)])
                keep = (left_start < left_end) & (right_start < right_end) & (below[4] <= distance)
                children.append(below[:, keep & ~own if one > two else keep])
        waiting.append((depth + 1, np.concatenate(children, axis=1)))


def spanning(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least place that each of ``n`` places is connected to."""
    low = np.arange(n)
    for i, j in links:
        while len(i):
            a, b = low[i], low[j]
            np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))  # only roots are hung on others
            while (low[low] != low).any():
                low = low[low]
            apart = low[i] != low[j]
            i, j = i[apart], j[apart]
    return low


def _links(units: DataFrame, distance: int) -> DataFrame:
    """``node, low``: links that connect, unit by unit, all fingerprints within the distance."""
    def join(rows: pa.Table) -> pa.Table:
        keys = np.sort(rows["key"].to_numpy().view(np.uint64))
        first, second, depth = (rows[name][0].as_py() for name in _UNIT)
        same = first == second
        left = right = keys
        if not same:
            cut = np.searchsorted(keys, np.array([second], np.int64).view(np.uint64) << np.uint64(BITS - depth))[0]
            left, right = keys[:cut], keys[cut:]
        if not len(left) or not len(right):
            return pa.table({"node": pa.array([], pa.int64()), "low": pa.array([], pa.int64())})
        shift = 0 if same else len(left)
        found = ((i, j + shift) for i, j in close_pairs(left, right, depth, distance, same))
        low = spanning(len(keys), found)
        moved = np.flatnonzero(low != np.arange(len(keys)))
        return pa.table({"node": pa.array(keys[moved].view(np.int64)), "low": pa.array(keys[low[moved]].view(np.int64))})

    pairs = units.groupBy(*_UNIT).applyInArrow(join, "node long, low long")
    return pairs.select(F.greatest("node", "low").alias("node"), F.least("node", "low").alias("low"))


def near_keys(keys: DataFrame, distance: int) -> DataFrame:
    """``node, low`` for every one of the distinct ``key`` that is connected to a
    lower one: the lowest it is connected to."""
    units = _units(keys, distance)
    result = components(_links(units.rows, distance), "simhash-groups")
    units.remove()
    return result


def group_documents(documents: DataFrame, rule: Fingerprinting = Fingerprinting()) -> DataFrame:
    """``doc_id, copy, fingerprint, component_id, kept`` for every row; ``copy`` is a
    hash of the text, the component the smallest id reachable, which is kept."""
    signed = write_stage(_signed(documents, rule), "fingerprints")
    classes = new_stage(signed.groupBy("key").agg(F.min("doc_id").alias("least")), "simhash-classes")
    groups = near_keys(classes.rows.select("key"), rule.distance).withColumnRenamed("node", "key")
    rooted = new_stage(classes.rows.join(groups, "key", "left").withColumn("root", F.coalesce("low", "key")), "simhash-roots")
    named = rooted.rows.groupBy("root").agg(F.min("least").alias("component_id"))
    homes = write_stage(rooted.rows.join(named, "root").select("key", "component_id"), "simhash-homes")
    rooted.remove()
    classes.remove()
    return signed.join(homes, "key").select(
        "doc_id", "copy", F.lpad(F.lower(F.hex("key")), 16, "0").alias("fingerprint"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
