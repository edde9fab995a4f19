"""Reply trees: root-to-leaf paths, ranked by score, each formatted as one conversation.

Paths are found by self-joins that double the stride: after ``t`` rounds every
message knows the ancestor ``2^t`` steps up and the sum of scores on the way.
A tree of depth ``d`` takes ``log2 d`` rounds over one row per message, and only
the chosen leaves are expanded, so rows grow with the output, not with its square.

Defined results. Null texts and roles are empty; a null score is 0; null tree
ids are one tree. A parent that is missing makes its reply a root. Messages
with an equal id in one tree count once (the first by role and text). A cycle of
parents is an error. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailrisk.llm.common import prefixed
from mailrisk.session import Stage, new_stage, write_stage

# The template's marks, and strings with a meaning to some template.
START, END = "<|im_start|>", "<|im_end|>"
_ANGLE = r"<(?=\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>)"
_SQUARE = r"\[(?=/?INST\])"


def escape(text: Column) -> Column:
    """Control strings lose their first character to ``~1`` or ``~2``; ``~`` is ``~0``."""
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("~"), F.lit("~0"))
    return F.regexp_replace(F.regexp_replace(plain, _ANGLE, "~1"), _SQUARE, "~2")


def escape_role(role: Column) -> Column:
    """As ``escape``; line breaks, which end the role, become ``~3``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("~3"))


def unescape(text: Column) -> Column:
    for code, character in (("~1", "<"), ("~2", "["), ("~3", "\n"), ("~0", "~")):
        text = F.replace(text, F.lit(code), F.lit(character))
    return text


def chains(conversations: DataFrame) -> DataFrame:
    """Linear conversations ``(conv_id, turn, role, text)`` as reply trees:
    every row answers the one before it. Equal turns go by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        F.col("conv_id").alias("tree"), F.row_number().over(order).cast("long").alias("message"), "role", "text"
    ).select(
        "tree", "message", F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"),
    )


def _same(left: str, right: str) -> Column:
    return F.col("tree").eqNullSafe(F.col("o_tree")) & (F.col(left) == F.col(right))


def _open(level: Stage) -> DataFrame:
    return level.rows.filter(F.col("jump").isNotNull())


def _strides(messages: DataFrame) -> list[Stage]:
    """Written tables ``tree, message, jump, total, steps``. The t-th has the
    messages with an ancestor ``2^(t-1)`` up; its jumps go ``2^t`` up, and a row
    without one has its whole path in ``total`` and ``steps``. So messages leave
    as soon as their root is known, and the last table has no jumps."""
    own = messages.select("tree", "message", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("total"))
    known = prefixed(messages.select("tree", "message"), "o_")
    first = own.join(known, _same("parent", "o_message"), "left").select(
        "tree", "message", F.col("o_message").alias("jump"), "total", F.lit(1).cast("long").alias("steps")
    )
    levels = [new_stage(first, "strides")]
    size = None
    while not _open(levels[-1]).isEmpty():
        size = size or levels[0].rows.count()
        if 2 ** (len(levels) - 1) > size:
            raise ValueError("the parents of some messages form a cycle")
        state = _open(levels[-1])
        for level in levels:
            state = state.unionByName(level.rows.filter(F.col("jump").isNull()))
        further = _open(levels[-1]).join(prefixed(state, "o_"), _same("jump", "o_message")).select(
            "tree", "message", F.col("o_jump").alias("jump"),
            (F.col("total") + F.col("o_total")).alias("total"), (F.col("steps") + F.col("o_steps")).alias("steps"),
        )
        levels.append(new_stage(further, "strides"))
    return levels


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``tree, leaf, rank, path_score, back, role, text`` for every message on
    the ``branches`` best root-to-leaf paths of each tree.

    Paths rank by mean score, then by length, then by leaf id; ``back`` counts
    from the leaf. The number of branches is the feature's own limit.
    """
    unique = write_stage(
        messages.groupBy("tree", "message").agg(
            F.min(F.struct("role", "text", "parent", "score")).alias("m")
        ).select("tree", "message", "m.*"),
        "messages",
    )
    levels = _strides(unique)
    settled = levels[0].rows.filter(F.col("jump").isNull())
    for level in levels[1:]:
        settled = settled.unionByName(level.rows.filter(F.col("jump").isNull()))
    answered = prefixed(_open(levels[0]).select("tree", "jump"), "o_")
    leaves = settled.join(answered, _same("message", "o_jump"), "left_anti")
    mean = F.col("total") / F.col("steps")
    order = Window.partitionBy("tree").orderBy(mean.desc(), F.col("steps").desc(), "message")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= branches)
    steps = write_stage(
        chosen.select(
            "tree", F.col("message").alias("leaf"), "rank", mean.alias("path_score"), "message",
            F.lit(0).cast("long").alias("back"),
        ),
        "paths",
    )
    for stride, level in enumerate(levels[:-1]):
        # Known steps reach 2^stride up without a gap; a jump of that length doubles it.
        jumps = prefixed(_open(level).select("tree", "message", "jump"), "o_")
        further = steps.join(jumps, _same("message", "o_message")).select(
            "tree", "leaf", "rank", "path_score", F.col("o_jump").alias("message"),
            (F.col("back") + 2**stride).alias("back"),
        )
        steps = steps.unionByName(write_stage(further, "paths"))
    for level in levels:
        level.remove()
    texts = prefixed(unique.select("tree", "message", "role", "text"), "o_")
    return steps.join(texts, _same("message", "o_message")).select(
        "tree", "leaf", "rank", "path_score", "back", F.col("o_role").alias("role"), F.col("o_text").alias("text")
    )


def format_paths(paths: DataFrame, learned: str = "assistant") -> DataFrame:
    """``tree, leaf, rank, path_score, formatted, mask``: one row per path.

    ``mask`` lists the texts that training learns from, those of the role
    ``learned``, as ``(start, length)`` in UTF-8 bytes of ``formatted``.
    Byte offsets come from a running sum in the path's own sort order.
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    rows = paths.withColumn("_head", head).withColumn("_body", escape(F.col("text")))
    piece = F.concat("_head", "_body", F.lit(f"{END}\n"))
    before = Window.partitionBy("tree", "leaf", "rank", "path_score").orderBy(F.col("back").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    start = F.coalesce(F.sum(F.octet_length("_piece")).over(before), F.lit(0)) + F.octet_length("_head")
    placed = rows.withColumn("_piece", piece).select(
        "tree", "leaf", "rank", "path_score",
        F.struct(
            (-F.col("back")).alias("at"), "_piece", (F.coalesce("role", F.lit("")) == learned).alias("learned"),
            start.cast("long").alias("start"), F.octet_length("_body").cast("long").alias("length"),
        ).alias("turn"),
    )
    turns = placed.groupBy("tree", "leaf", "rank", "path_score").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    taught = F.filter("turns", lambda turn: turn["learned"])
    return turns.select(
        "tree", "leaf", "rank", "path_score",
        F.array_join(F.transform("turns", lambda turn: turn["_piece"]), "").alias("formatted"),
        F.transform(taught, lambda turn: F.struct(turn["start"].alias("start"), turn["length"].alias("length"))).alias("mask"),
    )


def read_turns(formatted: Column) -> Column:
    """``(role, text)`` of every turn, read back from a formatted conversation."""
    ending = len(END) + 1

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        size = F.length(piece) - F.length(role) - 1 - ending
        return F.struct(
            unescape(role).alias("role"), unescape(F.substr(piece, F.length(role) + 2, size)).alias("text")
        )

    pieces = F.split(formatted, r"<\|im_start\|>", -1)
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)


def masked_text(formatted: Column, mask: Column) -> Column:
    """The unescaped texts under the mask, nothing between them. Slices are cut
    from the bytes, so each costs its own length only."""
    def cut(span: Column) -> Column:
        part = F.substr(F.encode(formatted, "UTF-8"), (span["start"] + 1).cast("int"), span["length"].cast("int"))
        return unescape(F.decode(part, "UTF-8"))

    return F.array_join(F.transform(mask, cut), "")
