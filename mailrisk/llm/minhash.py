"""Near-duplicate groups: SuperMinHash signatures, banding, verification, union-find.

A SuperMinHash signature draws one random permutation of the registers per
element; the ``j``-th rank touches a register with a value in ``[j, j + 1)``.
The correlation of the ranks lowers the variance, and as soon as all registers
of a document are below ``j + 1`` no later rank can change them, so large sets
stop after a rank or two.

Defined results. Words are parted by white space, A-Z lower-cased. A text with
fewer words than a shingle is one shingle; null and empty texts have none and
are linked with nothing. Documents are their ids: rows repeated under an id are
one document. Documents without an id join a group only by an equal set, never
stand for a group that has an id, and stay if their set has none. Extra columns
are ignored. Texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailrisk.llm.components import components
from mailrisk.llm.hashing import chunks, mix, word_hashes
from mailrisk.session import Stage, new_stage, ship_with_tasks, write_stage

ship_with_tasks(__name__)

_GOLDEN = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Similarity:
    """Shingle size, lowest similarity in percent, and the banding. With 28
    bands of 4 registers a pair at 80 % is missed once in 2.5 million times,
    unless a third document links it anyway."""

    words: int = 5
    percent: int = 80
    bands: int = 28
    rows: int = 4


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    split = [text.lower().split() for text in texts]
    ends = np.cumsum([len(words) for words in split])
    hashes = word_hashes([word for words in split for word in words])
    joined = hashes[: max(len(hashes) - size + 1, 0)].copy()
    for ahead in range(1, size):
        joined = mix(joined) + hashes[ahead : ahead + len(joined)]
    joined = mix(joined)
    sets = []
    for words, end in zip(split, ends.tolist()):
        start = end - len(words)
        if len(words) >= size:
            sets.append(np.unique(joined[start : end - size + 1]))
            continue
        whole = np.full(1, len(words), np.uint64) * np.uint64(_GOLDEN)  # apart from all longer ones
        for at in range(start, end):
            whole = mix(whole) + hashes[at]
        sets.append(mix(whole) if words else np.empty(0, np.uint64))
    return sets


def super_minhash(sets: list[np.ndarray], registers: int) -> np.ndarray:
    """Signatures, one row per set; a register holds rank and fraction as one number.

    Works rank by rank on the elements of all sets whose registers a later rank
    can still lower. The register a rank touches follows from undoing the swaps
    of the earlier ranks, so no permutation is stored.
    """
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    values = np.full(len(sets) * registers, np.iinfo(np.uint64).max, np.uint64)
    swaps: list[np.ndarray] = []
    for rank in range(registers):
        if not len(elements):
            break
        draw = mix(elements + np.uint64((rank + 1) * _GOLDEN & 0xFFFFFFFFFFFFFFFF))
        target = rank + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(registers - rank) >> np.uint64(32)).astype(np.int64)
        swaps.append(target)
        place = target
        for earlier in range(rank - 1, -1, -1):
            place = np.where(place == swaps[earlier], earlier, place)
        np.minimum.at(values, owners * registers + place, np.uint64(rank << 32) | (draw >> np.uint64(32)))
        open_sets = values.reshape(len(sets), registers).max(axis=1) >= np.uint64((rank + 1) << 32)
        still = open_sets[owners]
        if not still.all():
            owners, elements = owners[still], elements[still]
            swaps = [swap[still] for swap in swaps]
    return values.reshape(len(sets), registers)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_GOLDEN), parts.shape[:2])
    for row in range(rows):
        keys = mix(keys + parts[:, :, row])
    return keys.view(np.int64)


def _signed(documents: DataFrame, rule: Similarity) -> DataFrame:
    """``doc_id, copy, digest, n_shingles, bands``; a set is known by 128 bits of its shingles."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches, "text"):
            sets = shingle_sets(texts, rule.words)
            filled = [at for at, one in enumerate(sets) if len(one)]
            keys = band_keys(super_minhash([sets[at] for at in filled], rule.bands * rule.rows), rule.bands, rule.rows)
            bands: list = [None] * len(sets)
            digests: list = [None] * len(sets)
            for row, at in enumerate(filled):
                bands[at] = keys[row]
                digests[at] = hashlib.blake2b(sets[at].tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), rows.column("copy"), pa.array(digests, pa.binary()),
                    pa.array([len(one) for one in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "copy", "digest", "n_shingles", "bands"],
            )

    rows = documents.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("copy"), F.col("text").cast("binary").alias("text")
    )
    return rows.mapInArrow(sign, "doc_id long, copy long, digest binary, n_shingles long, bands array<long>")


def _sets_of(documents: DataFrame, wanted: DataFrame, rule: Similarity) -> Stage:
    """Written ``doc_id, shingles`` of the documents that share a bucket."""
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches, "text"):
            sets = [one.tobytes() for one in shingle_sets(texts, rule.words)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return new_stage(rows.join(wanted, "doc_id", "left_semi").mapInArrow(collect, "doc_id long, shingles binary"), "sets")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` of ``node`` and ``low`` with both sets. A node's set travels once
    per pair; a hub's set meets its pairs in a join that can be split."""
    mine = sets.select(F.col("doc_id").alias("node"), F.col("shingles").alias("mine"))
    theirs = sets.select(F.col("doc_id").alias("low"), F.col("shingles").alias("theirs"))
    return pairs.join(mine, "node").join(theirs, "low")


def _similar(common: int, left: int, right: int, percent: int) -> bool:
    return 100 * common >= percent * (left + right - common)


def _verified(pairs: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs ``node``, ``low`` whose full sets are similar enough."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column("mine"), batch.column("theirs")):
                left, right = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                common = len(np.intersect1d(left, right, assume_unique=True))
                good.append(_similar(common, len(left), len(right), rule.percent))
            yield batch.select(["node", "low"]).filter(pa.array(good, pa.bool_()))

    return _with_sets(pairs, sets).mapInArrow(check, "node long, low long")


def _compared(pairs: DataFrame, sets: DataFrame, rule: Similarity) -> Stage:
    """Members (``node``) against their hub (``low``): ``n`` shingles, ``alike``, and
    as ``marks`` the ``apart`` shingles of the symmetric difference.

    Two members x and y that are alike have a difference of at most
    ``s = (1 - t) / (1 + t) * (|x| + |y|)`` shingles, so their differences from
    the hub share at least half of ``apart_x + apart_y - s``. If x is not alike
    the hub, that is more than ``apart_y * (1 - (1 - t) / (1 + t)) / 2``. The
    member with the larger difference shares no less than ``apart - s``, the one
    with the smaller no less than ``apart - s / 2``. Hence, in any order that all
    members of a hub have in common, the first shingle they share lies among the
    first ``n_probe`` of the larger and the first ``n_index`` of the smaller
    difference.
    """
    share = rule.percent / 100
    gap = (1 - share) / (1 + share)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for a, b in zip(batch.column("mine"), batch.column("theirs")):
                own, hub = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                added, dropped = np.setdiff1d(own, hub, True), np.setdiff1d(hub, own, True)
                apart = len(added) + len(dropped)
                alike = _similar(len(own) - len(added), len(own), len(hub), rule.percent)
                # A thousandth is taken off against rounding; marks only get more.
                most = gap * len(own) * (1 + 1 / share)
                odd = math.floor(apart * (1 - gap) / 2 - 0.001) + 1
                larger = max(1, math.ceil(apart - most - 0.001), odd if alike else 1)
                smaller = max(1, math.ceil(apart - most / 2 - 0.001), odd)
                n_probe, n_index = max(apart - larger + 1, 1), max(apart - smaller + 1, 1)
                marks = np.concatenate([added, dropped])
                for column, value in zip(columns, (len(own), alike, apart, n_probe, n_index, marks.view(np.int64))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"), batch.column("low"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()),
                    pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.int32()),
                    pa.array(columns[5], pa.list_(pa.int64())),
                ],
                names=["node", "low", "n", "alike", "apart", "n_probe", "n_index", "marks"],
            )

    schema = "node long, low long, n long, alike boolean, apart long, n_probe int, n_index int, marks array<long>"
    return new_stage(_with_sets(pairs, sets).mapInArrow(compare, schema), "compared")


def _placed(grouped: DataFrame) -> DataFrame:
    """``grouped`` members with one row per ``mark`` that others of the hub have, too,
    and its place ``at`` in the order from rare to common marks, where marks of
    one member come first. Hubs that all members are alike, or with one member,
    have no rows."""
    hubs = grouped.groupBy("low").agg(F.count(F.lit(1)).alias("n"), F.bool_or(~F.col("alike")).alias("odd")).filter("n > 1 AND odd")
    marks = grouped.join(hubs.select("low"), "low", "left_semi").select("node", F.col("low").alias("hub"), F.explode("marks").alias("mark"))
    common = marks.groupBy("hub", "mark").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    shared = marks.join(common, ["hub", "mark"]).groupBy("node", "hub").agg(
        F.array_sort(F.collect_list(F.struct("held", "mark"))).alias("shared")
    )
    members = grouped.drop("marks").withColumnRenamed("low", "hub").join(shared, ["node", "hub"])
    alone = F.col("apart") - F.size("shared")
    return members.select("*", F.posexplode("shared").alias("at", "one")).select(
        *members.drop("shared").columns, F.col("one.mark").alias("mark"), (F.col("at") + alone).alias("at")
    )


def _possible(grouped: DataFrame, rule: Similarity) -> DataFrame:
    """``node, low`` of members of one hub, not both alike it and not in one group
    (``root``) yet, that may be alike by what they differ in from the hub.

    A pair is only needed at the first shingle it shares, so at a shared shingle
    each member can share no more than what follows in its own difference: a
    shingle that many have in common comes late in all of them, where too little
    follows, and makes no pairs.
    """
    percent = rule.percent
    placed = new_stage(_placed(grouped).filter(F.col("at") < F.greatest("n_probe", "n_index")), "marks")

    def role(length: str, prefix: str) -> DataFrame:
        return placed.rows.filter(F.col("at") < F.col(length)).select(
            "hub", "mark", *(F.col(name).alias(prefix + name) for name in ("node", "n", "apart", "alike", "root", "at"))
        )

    n, apart = F.col("n") + F.col("low_n"), F.col("apart") + F.col("low_apart")
    after = F.least(F.col("apart") - F.col("at"), F.col("low_apart") - F.col("low_at"))
    possible = (
        (F.col("root") != F.col("low_root")) & ~(F.col("alike") & F.col("low_alike"))
        & (F.struct("low_apart", "low_node") < F.struct("apart", "node"))
        & (F.least("n", "low_n") * 100 >= F.greatest("n", "low_n") * percent)
        & ((F.col("apart") - F.col("low_apart")) * (100 + percent) <= n * (100 - percent))
        & (2 * after * (100 + percent) >= apart * (100 + percent) - n * (100 - percent))
    )
    met = role("n_probe", "").join(role("n_index", "low_"), ["hub", "mark"]).filter(possible)
    pairs = new_stage(_ordered(met.select("node", F.col("low_node").alias("low"))).distinct(), "possible")
    placed.remove()
    return pairs.rows


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("node", "low").alias("node"), F.least("node", "low").alias("low"))


def near_links(classes: DataFrame, documents: DataFrame, rule: Similarity) -> DataFrame:
    """``node, low`` per class representative outside its group's smallest one.

    ``classes`` has ``rep`` and ``bands``. A bucket's hub is the member that shares
    most places in buckets with others, for edited copies the text they stem
    from. Every member is compared with its hubs, which is linear. Members of one
    bucket that are then in different groups are alike only if their differences
    from the hub overlap, so they are joined on the first shingles of those
    differences (see ``_compared`` and ``_possible``) and verified. Every pair that shares a bucket
    is in one group, verified, or proven not alike, whatever a bucket's size.
    """
    spread = classes.filter(F.col("rep").isNotNull()).select("rep", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    members = new_stage(spread.join(shared, "band"), "buckets")
    sets = _sets_of(documents, members.rows.select(F.col("rep").alias("doc_id")).distinct(), rule)

    company = members.rows.groupBy("rep").agg(F.sum("size").alias("company"))
    hubs = (
        members.rows.join(company, "rep").groupBy("band")
        .agg(F.max(F.struct("company", (-F.col("rep")).alias("id"))).alias("hub"))
        .select("band", (-F.col("hub.id")).alias("low"))
    )
    spokes = members.rows.join(hubs, "band").filter(F.col("rep") != F.col("low"))
    compared = _compared(spokes.select(F.col("rep").alias("node"), "low").distinct(), sets.rows, rule)
    stars = components(_ordered(compared.rows.filter("alike")), "stars")

    roots = stars.select("node", F.col("low").alias("root"))
    grouped = compared.rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    pairs = _possible(grouped, rule)
    result = components(stars.unionByName(_verified(pairs, sets.rows, rule)), "groups")
    for stage in (members, sets, compared):
        stage.remove()
    return result


def group_documents(documents: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """``doc_id, copy, n_shingles, component_id, kept`` for every row; ``copy`` is
    a hash of the text. The component is the smallest id reachable by links; its
    bearer is kept."""
    signed = write_stage(_signed(documents, rule), "signatures")
    classes = new_stage(
        signed.filter(F.col("digest").isNotNull()).groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    links = near_links(classes.rows, documents, rule)
    home = write_stage(
        classes.rows.select("digest", "rep").join(links.withColumnRenamed("node", "rep"), "rep", "left").select(
            "digest", F.coalesce("low", "rep").alias("home")
        ),
        "homes",
    )
    classes.remove()
    component = F.coalesce("home", "doc_id")
    return signed.select("doc_id", "copy", "digest", "n_shingles").join(home, "digest", "left").select(
        "doc_id", "copy", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_one(documents: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """The rows of ``documents`` that stand for their group, one row per id; rows
    without an id are told apart by their text. Only what does repeat is looked
    at for repetitions."""
    own = F.when(F.col("doc_id").isNull(), F.col("copy"))
    standing = group_documents(documents, rule).filter("kept").groupBy(
        F.col("doc_id").alias("_id"), own.alias("_text_of")
    ).agg(F.count(F.lit(1)).alias("_rows"))
    row = F.struct(*(F.col(f"`{name}`") for name in documents.columns)).alias("_row")
    rows = documents.select(row, F.col("doc_id").alias("_own"), F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias("_told"))
    kept = rows.join(standing, F.col("_own").eqNullSafe(F.col("_id")) & F.col("_told").eqNullSafe(F.col("_text_of")))
    single = kept.filter(F.col("_rows") == 1)
    repeated = kept.filter(F.col("_rows") > 1).dropDuplicates(["_id", "_text_of"])
    return single.unionByName(repeated).select("_row.*")
