"""Shards of near equal bytes by a k-d tree over document metadata.

A node is cut along its widest dimension, widths being relative to those of the
whole table, where the weighted median (or the share of its shards) lies, until
a leaf holds one shard's bytes. All nodes of a level are cut at once: weights
are summed by the leading 16 bits of the ordering key, then by the next ones
within the chosen prefix, so each pass is a map-side combined sum and no task
sorts a node. The order along a dimension goes on with a hash of the text, so
copies stay together unless they weigh too much for one shard's balance; then
a hash of the id goes on.

Defined results. A null text has no bytes and weighs ``overhead``; null metadata
sorts first. Rows repeated under one id and text cannot be told apart by the
tree and share a shard; they get slots of their own. Extra columns pass through
``shard_documents``. An empty table has no rows in any shard.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailrisk.session import new_stage

_CODE_BITS = 24
_DIGIT_BITS = 16
_MAJOR_BITS = 48
_MINOR_BITS = 32


@dataclass(frozen=True)
class Balance:
    """Groups of copies above ``whole_share`` of a shard's bytes may be cut;
    ``rows_per_block`` rows are numbered by one task."""

    overhead: int = 16
    whole_share: float = 1 / 16
    rows_per_block: int = 100_000


def number_code(value: Column) -> Column:
    """24-bit code in the order of a number of at least zero, finer for small ones."""
    scaled = F.log2(F.greatest(F.coalesce(value, F.lit(0)), F.lit(0)) + 1) * float(1 << (_CODE_BITS - 6))
    return F.least(F.floor(scaled), F.lit((1 << _CODE_BITS) - 1)).cast("long")


def text_code(value: Column) -> Column:
    """24-bit code in the byte order of a string's first three bytes."""
    start = F.substr(F.encode(F.coalesce(value, F.lit("")), "UTF-8"), F.lit(1), F.lit(3))
    return F.conv(F.rpad(F.hex(start), 6, "0"), 16, 10).cast("long")


def text_size(text: Column, overhead: int) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + overhead).cast("long")


def with_keys(documents: DataFrame, dimensions: dict[str, Column], balance: Balance = Balance()) -> DataFrame:
    """``documents`` with ``_size``, a key per dimension and ``_minor``."""
    tie = F.xxhash64("text").bitwiseAND((1 << (_MAJOR_BITS - _CODE_BITS)) - 1)
    keys = {
        f"_key_{name}": F.shiftleft(code, _MAJOR_BITS - _CODE_BITS).bitwiseOR(tie) for name, code in dimensions.items()
    }
    minor = F.xxhash64(F.lit(1), F.col("doc_id")).bitwiseAND((1 << _MINOR_BITS) - 1)
    return documents.withColumns({"_size": text_size(F.col("text"), balance.overhead), **keys, "_minor": minor})


@dataclass
class Node:
    """Shards ``first`` to ``first + shards - 1``; rows below ``(major, minor)``
    of ``key`` go left."""

    first: int
    shards: int
    key: str | None = None
    major: int = 0
    minor: int = 0
    children: list[Node] = field(default_factory=list)

    def leaves(self) -> list[Node]:
        return [leaf for child in self.children for leaf in child.leaves()] if self.children else [self]

    def shard(self) -> Column:
        """First shard of the leaf that a row belongs to."""
        if not self.children:
            return F.lit(self.first)
        left = (F.col(self.key) < self.major) | ((F.col(self.key) == self.major) & (F.col("_minor") < self.minor))
        return F.when(left, self.children[0].shard()).otherwise(self.children[1].shard())

    def cut(self, key: str, major: int, minor: int) -> None:
        half = self.shards // 2
        self.key, self.major, self.minor = key, major, minor
        self.children = [Node(self.first, half), Node(self.first + half, self.shards - half)]


def _lookup(values: dict[int, object], default) -> Column:
    """The value of the row's ``_node``, from one literal array."""
    return F.get(F.array(*(F.lit(values.get(node, default)) for node in range(max(values) + 1))), F.col("_node"))


def _descend(points: DataFrame, bits: int, aims: dict[int, float]):
    """Per node the value of ``_at`` at which the running weight reaches its
    aim, the weight below that value and the weight at it; 16 bits per pass."""
    found = {node: 0 for node in aims}
    below = {node: 0 for node in aims}
    here = {node: 0 for node in aims}
    for shift in range(bits - _DIGIT_BITS, -1, -_DIGIT_BITS):
        above = F.shiftright("_at", shift + _DIGIT_BITS) == _lookup(found, -1)
        digit = F.shiftright("_at", shift).bitwiseAND((1 << _DIGIT_BITS) - 1)
        weights = points.filter(above).groupBy("_node", digit.alias("digit")).agg(F.sum("_size").alias("weight"))
        so_far = F.sum("weight").over(Window.partitionBy("_node").orderBy("digit"))  # at most 65,536 rows a node
        rest = _lookup({node: float(aims[node] - below[node]) for node in aims}, 0.0)
        reached = weights.withColumn("total", so_far).filter(F.col("total") >= rest).groupBy("_node").agg(
            F.min(F.struct("digit", "total", "weight")).alias("hit")
        )
        for row in reached.collect():  # one row a node
            node, hit = row["_node"], row["hit"]
            found[node] = (found[node] << _DIGIT_BITS) | hit["digit"]
            below[node] += hit["total"] - hit["weight"]
            here[node] = hit["weight"]
    return found, below, here


def fit_tree(points: DataFrame, shards: int, balance: Balance = Balance()) -> Node:
    """The tree over ``with_keys`` rows; each leaf is one shard. Only sums, cuts
    and ranges, a few numbers per node, come to the driver."""
    root = Node(0, shards)
    keys = [name for name in points.columns if name.startswith("_key_")]
    span = None
    while open_nodes := {leaf.first: leaf for leaf in root.leaves() if leaf.shards > 1}:
        placed = points.withColumn("_node", root.shard())
        codes = [F.shiftright(key, _MAJOR_BITS - _CODE_BITS) for key in keys]
        ranges = [(F.max(code) - F.min(code)).alias(key) for key, code in zip(keys, codes)]
        stats = {
            row["_node"]: row
            for row in placed.filter(F.col("_node").isin(*open_nodes)).groupBy("_node")
            .agg(F.sum("_size").alias("weight"), *ranges).collect()
        }
        if not stats:  # no rows at all
            break
        span = span or {key: max([1, *(row[key] for row in stats.values())]) for key in keys}
        widest = {node: max(keys, key=lambda key: row[key] / span[key]) for node, row in stats.items()}
        aims = {node: row["weight"] * (open_nodes[node].shards // 2) / open_nodes[node].shards for node, row in stats.items()}
        own_key = F.get(F.array(*keys), _lookup({node: keys.index(key) for node, key in widest.items()}, None))
        keyed = placed.select("_node", "_size", "_minor", own_key.alias("_at")).filter(F.col("_at").isNotNull())
        major, below, here = _descend(keyed, _MAJOR_BITS, aims)
        leaf_bytes = {node: row["weight"] / open_nodes[node].shards for node, row in stats.items()}
        heavy = {node: aims[node] - below[node] for node in aims if here[node] > leaf_bytes[node] * balance.whole_share}
        minor_below: dict = {}
        if heavy:
            group = keyed.filter(F.col("_at") == _lookup({node: major[node] for node in heavy}, -1))
            minor, minor_below, minor_here = _descend(
                group.select("_node", "_size", F.col("_minor").alias("_at")), _MINOR_BITS, heavy
            )
        for node, leaf in open_nodes.items():
            if node not in aims:  # no rows
                leaf.cut(keys[0], 0, 0)
            elif node in heavy:
                after = heavy[node] - minor_below[node] > minor_here[node] / 2
                leaf.cut(widest[node], major[node], minor[node] + after)
            else:
                after = aims[node] - below[node] > here[node] / 2
                leaf.cut(widest[node], major[node] + after, 0)
    return root


def with_slots(sharded: DataFrame, rows: int, shards: int, order: list[str], balance: Balance = Balance()) -> DataFrame:
    """Adds ``slot``, gapless from 0 in every shard. A shard is numbered in
    blocks of hashed ids whose sizes are summed first, so no task sorts a whole shard."""
    blocks = max(1, -(-rows // (shards * balance.rows_per_block)))
    blocked = sharded.withColumn("_block", F.pmod(F.col("_minor"), F.lit(blocks)))
    counts = blocked.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("shard", "_block").orderBy(*order))
    numbered = blocked.withColumn("_place", place)
    return numbered.join(offsets, ["shard", "_block"]).withColumn(
        "slot", (F.col("_offset") + F.col("_place") - 1).cast("long")
    ).drop("_block", "_offset", "_place")


def metadata(documents: DataFrame) -> dict[str, Column]:
    """Dimensions that a document's copies share: bytes, language and characters."""
    found = {"bytes": number_code(F.octet_length("text").cast("long"))}
    if "lang" in documents.columns:
        found["lang"] = text_code(F.col("lang").cast("string"))
    if "n_chars" in documents.columns:
        found["chars"] = number_code(F.col("n_chars").cast("long"))
    return found


def _counted(points: DataFrame) -> tuple[int, int]:
    return tuple(points.agg(F.count(F.lit(1)), F.coalesce(F.sum("_size"), F.lit(0))).first())


def shard_documents(
    documents: DataFrame, shards: int | None = None, target_bytes: int | None = None, balance: Balance = Balance()
) -> DataFrame:
    """All columns of ``documents`` with ``size``, ``shard`` and ``slot``; either
    ``shards`` of equal bytes or as many as ``target_bytes`` calls for. Columns
    that already bear such a name are replaced."""
    given = F.struct(*(F.col(f"`{name}`") for name in documents.columns)).alias("given")
    packed = documents.select(given, *(name for name in ("doc_id", "text", "lang", "n_chars") if name in documents.columns))
    keyed = with_keys(packed, metadata(packed), balance)
    internal = [name for name in keyed.columns if name not in packed.columns]
    points = new_stage(keyed.select(*internal), "points")
    rows, total = _counted(points.rows)
    shards = shards or max(1, -(-total // target_bytes))
    tree = fit_tree(points.rows, shards, balance)
    points.remove()
    placed = keyed.withColumn("shard", tree.shard().cast("int"))
    numbered = with_slots(placed, rows, shards, ["doc_id", "_size", f"{internal[1]}"], balance)
    kept = (F.col(f"given.`{name}`") for name in documents.columns if name not in ("size", "shard", "slot"))
    return numbered.select(*kept, F.col("_size").alias("size"), "shard", "slot")
