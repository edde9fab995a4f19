"""Repair of the turn structure of conversations by the cheapest edits.

A valid conversation has the role initials ``(s?(ua)+)?``. Rows are kept, given
another role, deleted, and rows without text inserted; the cheapest edits come
from a shortest path through a graph whose nodes are (row, state of the grammar).
Many edits cost the same, so the path is made unique by its audit, the initials
of its edits: the least audit wins.

1. Cost. A row is a four by four matrix of costs between states; suffix products
   of these (minimum for sum, sum for product) are taken by doubling. They tell
   which arcs are optimal. From one node no two edits share an initial, so the
   least audit of a given length belongs to one path.
2. Ranks. Nodes are ranked by their least audits of length 1, 2, 4 and so on: two
   halves of an audit are ranked already, the second at the node the first leads
   to, so a round ranks pairs of numbers and doubles the pointers.
3. Path. The ranks tell which of several ends has the least path, and the doubled
   pointers give all nodes of that path at once.

No conversation has to fit anywhere. Rows are sorted by ranges and cut into
pieces of consecutive rows (an Arrow batch at most); a piece of a longer
conversation is summed up as the costs from each state to each state and the
ranks of the least audits behind them. Such sums are associative, so they are
combined in a tree of bounded fan-in and the chosen states handed back down it.
Only a conversation's audit and digest are single values by their nature;
texts pass the digest one after another, in bounded memory.

Defined results. Null roles and texts are one space, which is no valid role and a
blank text. Rows go by turn, nulls first, then by the MD5 of length of role,
colon, role and text, so repeated rows stand together. A null ``conv_id`` is a
conversation like any other. Extra columns are ignored. A conversation left
without rows has zeros and an empty audit; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailrisk.llm.common import PLACE_BITS, numbered, spaced
from mailrisk.session import new_stage, ship_with_tasks, write_stage

ship_with_tasks(__name__)

# Costs of edits, their initials in order, roles by code, endings.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
EDITS = "DIKR"
ROLES = ("system", "user", "assistant")
ENDINGS = ".!?"
# States: nothing yet, after s, after u, after a. The one row that may be
# inserted, and the state it leads to; rows still lacking at the end.
_LACKS = np.array([1, 1, 2, 1])
_NEXT = np.array([2, 2, 3, 2])
_MISSING = np.array([0, 2, 1, 0])
_NEVER = 1 << 28
# Code of a row: role (3: other) + must be deleted * 4 + truncated * 8.
_CODES = 16
_NO_STATE = -1
# Pieces are combined by equal upper bits of their place: a range, 2**12 ranges, ...
_LEVELS = (PLACE_BITS, PLACE_BITS + 12, PLACE_BITS + 24, 63)


def _kept_state(code: int, state: int) -> int:
    """State after a kept row, or none."""
    role = code & 3
    if code & 4 or role == 3 or (role == 0 and state) or (role and _LACKS[state] != role):
        return _NO_STATE
    return 1 if role == 0 else int(_NEXT[state])


_KEPT = np.array([[_kept_state(code, state) for state in range(4)] for code in range(_CODES)])
_EXTRA = np.array([TRUNCATED * (code >> 3) for code in range(_CODES)])
_FREE = np.array([not code & 4 for code in range(_CODES)])


def _product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cheapest costs through both, from each state to each state."""
    return np.minimum((left[..., :, :, None] + right[..., None, :, :]).min(axis=-2), _NEVER)


def _steps() -> np.ndarray:
    """Costs of a row by code: any insertions before it, then its own edit."""
    insert, row = np.full((4, 4), _NEVER), np.full((_CODES, 4, 4), _NEVER)
    for state in range(4):
        insert[state, state] = 0
        insert[state, _NEXT[state]] = INSERT
    insert = _product(_product(insert, insert), insert)
    for code in range(_CODES):
        for state in range(4):
            row[code, state, state] = DELETE
            if _FREE[code]:
                row[code, state, _NEXT[state]] = min(REROLE + _EXTRA[code], row[code, state, _NEXT[state]])
            if _KEPT[code, state] >= 0:
                row[code, state, _KEPT[code, state]] = _EXTRA[code]
    return _product(insert[None], row)


_STEP = _steps()
_END_COSTS = _MISSING * INSERT


def suffix_costs(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Costs from before each row to the end of its piece, between all states;
    ``ends`` holds for each row the end of its piece."""
    costs = _STEP[codes]
    ahead, longest = 1, int((ends - np.arange(len(codes))).max(initial=0))
    while ahead < longest:
        inner = np.flatnonzero(np.arange(len(codes)) + ahead < ends)
        costs[inner] = _product(costs[inner], costs[inner + ahead])
        ahead *= 2
    return costs


def ranked_paths(codes: np.ndarray, lengths: np.ndarray, goals: np.ndarray, closing: np.ndarray):
    """Costs, ranks and doubled pointers of the least optimal audits.

    ``goals`` are the costs that remain at each state after a piece, for one or
    more goals: (pieces, goals, 4); ``closing`` tells the pieces whose missing
    last rows may be inserted. Nodes are numbered (position, goal, state), where
    every piece has one position after its rows. Returns per-row costs, ranks,
    pointers by power of two, letters and the first position of each piece.
    """
    pieces, n_goals = len(lengths), goals.shape[1]
    piece = np.repeat(np.arange(pieces), lengths)
    row_costs = suffix_costs(codes, np.cumsum(lengths)[piece])
    position, last = np.arange(len(codes)) + piece, np.cumsum(lengths) + np.arange(pieces)
    cost = np.empty((len(codes) + pieces, n_goals, 4), np.int64)
    cost[last] = goals
    cost[position] = np.minimum((row_costs[:, None] + goals[piece][:, :, None, :]).min(axis=3), _NEVER)

    node = np.arange(cost.size).reshape(cost.shape)
    letter, pointer = np.zeros(cost.shape, np.int64), node.copy()

    def choose(at: np.ndarray, edit: int, price: np.ndarray, target: np.ndarray, allowed: np.ndarray) -> None:
        """Take an edit where it is optimal and no edit with a lower initial is."""
        flat = cost.reshape(-1)
        best = allowed & (letter[at] == 0) & (cost[at] < _NEVER) & (price + flat[target] == cost[at])
        letter[at] = np.where(best, edit, letter[at])
        pointer[at] = np.where(best, target, pointer[at])

    everywhere = np.ones((len(codes), n_goals, 4), bool)
    below = node[position + 1]
    kept, free = _KEPT[codes][:, None, :], _FREE[codes][:, None, None]
    extra = _EXTRA[codes][:, None, None]
    choose(position, 1, np.int64(DELETE), below, everywhere)
    choose(position, 2, np.int64(INSERT), node[position][:, :, _NEXT], everywhere)
    choose(position, 3, extra, below[:, :, :1] + np.maximum(kept, 0), everywhere & (kept >= 0))
    choose(position, 4, REROLE + extra, below[:, :, _NEXT], everywhere & free)
    shut = last[closing]
    letter[shut] = np.where(_MISSING > 0, 2, 0)
    pointer[shut] = np.where(_MISSING > 0, node[shut][:, :, _NEXT], node[shut])

    pointers, rank = [pointer.reshape(-1)], letter.reshape(-1)
    while (pointers[-1][pointers[-1]] != pointers[-1]).any():
        half = pointers[-1]
        rank = np.unique(rank * (rank.max() + 1) + rank[half], return_inverse=True)[1]
        pointers.append(half[half])
    return row_costs, rank.reshape(cost.shape), pointers, letter.reshape(-1), last - lengths


def walk(start: np.ndarray, pointers: list[np.ndarray], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes with an edit on the paths from ``start``, and whose path they are on."""
    counted = [(letters > 0).astype(np.int64)]
    for half in pointers[:-1]:
        counted.append(counted[-1] + counted[-1][half])
    lengths = counted[-1][start]
    # The last pointers reach every end: the paths are no longer than their power of two.
    path = np.repeat(np.arange(len(start)), lengths)
    step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    nodes = start[path]
    for power, doubled in enumerate(pointers):
        nodes = np.where(step >> power & 1, doubled[nodes], nodes)
    return nodes, path


def conversation_key(conv_id: str = "conv_id") -> Column:
    """A conversation's name, never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))


def _letters(text: Column) -> Column:
    return F.trim(spaced(text))


def turns(conversations: DataFrame) -> DataFrame:
    """Written ``conv, turn, role, text, same, _place, blank, truncated, initial``, in
    conversation order; ``same`` is a digest of role and text."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    rows = conversations.select(conversation_key().alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("same", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    letters = _letters(F.col("text"))
    rows = rows.withColumns({
        "blank": letters == "", "truncated": ~F.right(letters, F.lit(1)).isin(*ENDINGS), "initial": F.left("role", F.lit(1)),
    })
    return write_stage(numbered(rows, "conv", F.asc_nulls_first("turn"), "same"), "turns")


def faults(rows: DataFrame) -> DataFrame:
    """Written ``conv, turn, _place, fault, initial`` of ``turns``: the first of
    blank, duplicate (said before in the conversation) and truncated."""
    first = rows.filter(~F.col("blank")).groupBy("conv", "same").agg(F.min("_place").alias("_place"))
    marked = rows.select("conv", "turn", "_place", "blank", "truncated", "initial").join(
        first.select("_place", F.lit(True).alias("new")), "_place", "left"
    )
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate")
        .when(F.col("truncated"), "truncated").otherwise("")
    )
    return write_stage(marked.select("conv", "turn", "_place", fault.alias("fault"), "initial"), "faults")


def _illegal(initials: bytes) -> int:
    return sum(initials[at : at + 2] not in (b"\0\1", b"\1\2", b"\2\1") for at in range(len(initials) - 1))


def pieces(marked: DataFrame) -> DataFrame:
    """Written ``conv, spot, places, codes, illegal``: consecutive rows of one
    conversation, a byte each, with their places as long integers."""
    role = F.lit(3)
    for code, name in enumerate(ROLES):
        role = F.when(F.col("initial") == name[0], code).otherwise(role)
    code = role + F.when(F.col("fault").isin("blank", "duplicate"), 4).when(F.col("fault") == "truncated", 8).otherwise(0)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, place = batch.column("conv"), batch.column("_place").to_numpy()
            codes = batch.column("code").to_numpy().astype(np.uint8)
            named = np.asarray(conv.dictionary_encode().indices)
            starts = np.flatnonzero((np.diff(named, prepend=-1) != 0) | (np.diff(place >> PLACE_BITS, prepend=-1) != 0))
            spans = list(zip(starts.tolist(), [*starts[1:].tolist(), len(codes)]))
            yield pa.RecordBatch.from_arrays(
                [
                    conv.take(pa.array(starts)), pa.array(place[starts]),
                    pa.array([place[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([codes[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([_illegal((codes[a:b] & 3).tobytes()) for a, b in spans], pa.int64()),
                ],
                names=["conv", "spot", "places", "codes", "illegal"],
            )

    ordered = (
        marked.select("conv", "_place", code.cast("int").alias("code"), F.shiftright("_place", PLACE_BITS).alias("_range"))
        .repartition("_range").sortWithinPartitions("_place").drop("_range")
    )
    return write_stage(ordered.mapInArrow(cut, "conv string, spot long, places binary, codes binary, illegal long"), "pieces")


_SUM = "conv string, spot long, costs array<long>, ranks array<long>, illegal long, first int, last int"


def _summed(long_pieces: DataFrame) -> DataFrame:
    """Pieces as costs and ranks from each state to each state."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = np.full((4, 4), _NEVER)
        np.fill_diagonal(ends, 0)
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.frombuffer(row["codes"], np.uint8)
                costs, ranks, *_ = ranked_paths(codes, np.array([len(codes)]), ends[None], np.array([False]))
                yield pa.RecordBatch.from_pylist([{
                    "conv": row["conv"], "spot": row["spot"], "costs": costs[0].ravel().tolist(),
                    "ranks": ranks[0].T.ravel().tolist(), "illegal": row["illegal"],
                    "first": int(codes[0] & 3), "last": int(codes[-1] & 3),
                }], schema=_ARROW_SUM)

    return long_pieces.select("conv", "spot", "codes", "illegal").mapInArrow(add, _SUM)


_ARROW_SUM = pa.schema([
    ("conv", pa.string()), ("spot", pa.int64()), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64())),
    ("illegal", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
])


def _square(values: list[int]) -> np.ndarray:
    return np.array(values, np.int64).reshape(4, 4)


def join_sums(one: tuple, two: tuple) -> tuple:
    """Costs and ranks through two neighbours. Audits of different ends differ
    and none begins another, so the first half decides wherever it can."""
    costs, ranks = _product(one[0], two[0]), np.empty((4, 4), np.int64)
    for state in range(4):
        order = []
        for end in range(4):
            through = one[0][state] + two[0][:, end]
            best = min(range(4), key=lambda via: (through[via], one[1][state, via]))
            order.append((one[1][state, best], two[1][best, end]))
        ranked = sorted(set(order))
        ranks[state] = [ranked.index(pair) for pair in order]
    return costs, ranks


def _combined(sums: DataFrame, shift: int) -> DataFrame:
    """Neighbouring sums as one; a group has at most 2**12 of them, or a range's."""
    def combine(rows: pa.Table) -> pa.Table:
        ordered = sorted(rows.to_pylist(), key=lambda row: row["spot"])
        total, illegal = (_square(ordered[0]["costs"]), _square(ordered[0]["ranks"])), ordered[0]["illegal"]
        for before, row in zip(ordered, ordered[1:]):
            total = join_sums(total, (_square(row["costs"]), _square(row["ranks"])))
            illegal += row["illegal"] + _illegal(bytes([before["last"], row["first"]]))
        return pa.Table.from_pylist([{
            "conv": ordered[0]["conv"], "spot": ordered[0]["spot"], "costs": total[0].ravel().tolist(),
            "ranks": total[1].ravel().tolist(), "illegal": illegal, "first": ordered[0]["first"], "last": ordered[-1]["last"],
        }], schema=_ARROW_SUM)

    grouped = sums.withColumn("_group", F.shiftright("spot", shift))
    return grouped.groupBy("conv", "_group").applyInArrow(combine, _SUM)


def _handed_down(sums: DataFrame, chosen: DataFrame, shift: int) -> DataFrame:
    """``conv, spot, entry, exit, closing`` of the sums whose group goes from an
    entry state to an exit state; ``closing`` marks a conversation's end."""
    schema = pa.schema([("conv", pa.string()), ("spot", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), ("closing", pa.bool_())])

    def hand(rows: pa.Table, told: pa.Table) -> pa.Table:
        ordered, given = sorted(rows.to_pylist(), key=lambda row: row["spot"]), told.to_pylist()[0]
        costs = [_square(row["costs"]) for row in ordered]
        remain = [np.full(4, _NEVER)]
        remain[0][given["exit"]] = 0
        for square in reversed(costs[1:]):
            remain.append(np.minimum((square + remain[-1][None]).min(axis=1), _NEVER))
        state, out = given["entry"], []
        for row, square, rest in zip(ordered, costs, reversed(remain)):
            ranks = _square(row["ranks"])[state]
            end = min(range(4), key=lambda one: (square[state, one] + rest[one], ranks[one]))
            out.append({"conv": row["conv"], "spot": row["spot"], "entry": state, "exit": end, "closing": False})
            state = end
        out[-1]["closing"] = given["closing"]
        return pa.Table.from_pylist(out, schema=schema)

    grouped = sums.withColumn("_group", F.shiftright("spot", shift)).groupBy("conv", "_group")
    told = chosen.withColumn("_group", F.shiftright("spot", shift)).groupBy("conv", "_group")
    return grouped.cogroup(told).applyInArrow(hand, "conv string, spot long, entry int, exit int, closing boolean")


def _states(cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv, spot, entry, exit, closing`` of the pieces of conversations with more
    than one, and ``conv, illegal`` of these."""
    several = cut.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("conv")
    levels = [new_stage(_summed(cut.join(several, "conv", "left_semi")), "sums").rows]
    used = []
    for shift in _LEVELS:
        if levels[-1].count() == levels[-1].select("conv").distinct().count():
            break
        levels.append(new_stage(_combined(levels[-1], shift), "sums").rows)
        used.append(shift)
    top = levels[-1]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for costs, ranks in zip(batch.column("costs").to_pylist(), batch.column("ranks").to_pylist()):
                total, order = _square(costs)[0] + _END_COSTS, _square(ranks)[0]
                ends.append(min(range(4), key=lambda end: (total[end], order[end])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("spot"), pa.array([0] * len(ends), pa.int32()), pa.array(ends, pa.int32()), pa.array([True] * len(ends))],
                names=["conv", "spot", "entry", "exit", "closing"],
            )

    chosen = top.mapInArrow(choose, "conv string, spot long, entry int, exit int, closing boolean")
    for level, shift in zip(reversed(levels[:-1]), reversed(used)):
        chosen = new_stage(_handed_down(level, chosen, shift), "states").rows
    return chosen, top.select("conv", F.col("illegal").alias("all_illegal"))


def _edited(cut: DataFrame, states: DataFrame) -> DataFrame:
    """Written ``conv, spot, illegal, cost, audit, rows``: the edits of each piece;
    ``rows`` are the rows that stay or come, with place (null: inserted) and the
    code of a new role (null: unchanged)."""
    row_type = pa.struct([("step", pa.int64()), ("place", pa.int64()), ("role", pa.int32())])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [np.frombuffer(one, np.uint8) for one in batch.column("codes").to_pylist()]
            places = np.concatenate([np.frombuffer(one, np.int64) for one in batch.column("places").to_pylist()])
            lengths, codes = np.array([len(one) for one in parts]), np.concatenate(parts)
            entry = np.array([one or 0 for one in batch.column("entry").to_pylist()])
            closing = np.array([one is not False for one in batch.column("closing").to_pylist()])
            goals = np.where(closing[:, None], _END_COSTS[None], 0)
            for at, end in enumerate(batch.column("exit").to_pylist()):
                if end is not None:
                    goals[at, np.arange(4) != end] = _NEVER
            costs, _, pointers, letters, first = ranked_paths(codes, lengths, goals[:, None], closing)
            start = first * 4 + entry
            nodes, path = walk(start, pointers, letters)
            letter, state, position = letters[nodes], nodes % 4, nodes // 4
            ends = np.searchsorted(path, np.arange(len(parts) + 1))
            audit = np.frombuffer(b" " + EDITS.encode(), np.uint8)[letter].tobytes().decode()
            place = places[np.minimum(position - path, len(places) - 1)]
            new_role = np.where(letter == 3, -1, _LACKS[state])
            # An audit's price is what its first node still has to pay, without the goal's own share.
            starts = np.cumsum(lengths) - lengths
            total = (costs[starts, entry] + goals).min(axis=1)
            lists = []
            for a, b in zip(ends.tolist(), ends[1:].tolist()):
                lists.append([
                    {"step": at - a, "place": None if letter[at] == 2 else int(place[at]), "role": None if new_role[at] < 0 else int(new_role[at])}
                    for at in range(a, b) if letter[at] != 1
                ])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv"), batch.column("spot"), batch.column("illegal"), pa.array(total),
                    pa.array([audit[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]), pa.array(lists, pa.list_(row_type)),
                ],
                names=["conv", "spot", "illegal", "cost", "audit", "rows"],
            )

    given = cut.join(states.select("spot", "entry", "exit", "closing"), "spot", "left")
    schema = "conv string, spot long, illegal long, cost long, audit string, rows array<struct<step:long,place:long,role:int>>"
    return write_stage(given.select("conv", "spot", "illegal", "codes", "places", "entry", "exit", "closing").mapInArrow(edit, schema), "edited")


def repaired_rows(edited: DataFrame, rows: DataFrame) -> DataFrame:
    """``conv, spot, step, role, text`` of all rows after the repair; ``spot`` and
    ``step`` give their order."""
    new = edited.select("conv", "spot", F.explode("rows").alias("row")).select("conv", "spot", "row.*")
    names = F.array(*(F.lit(name) for name in ROLES))
    given = rows.select(F.col("_place").alias("place"), F.col("role").alias("old"), "text")
    inserted = new.filter(F.col("place").isNull()).select("conv", "spot", "step", F.get(names, "role").alias("role"), F.lit("").alias("text"))
    stayed = new.filter(F.col("place").isNotNull()).join(given, "place").select(
        "conv", "spot", "step", F.coalesce(F.get(names, "role"), "old").alias("role"), "text"
    )
    return stayed.unionByName(inserted)


def digests(repaired: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` over ``role:text``, newline-joined; a conversation's
    texts are read one after another and never held together."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(names: list, values: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.string())], names=["conv", "repaired_sha256"])

        current, running = None, None
        for batch in batches:
            done: list[tuple] = []
            for conv, role, text in zip(*(batch.column(name).to_pylist() for name in ("conv", "role", "text"))):
                said = f"{role}:{text}".encode()
                if running is None or conv != current:
                    if running is not None:
                        done.append((current, running.hexdigest()))
                    current, running = conv, hashlib.sha256(said)
                else:
                    running.update(b"\n" + said)
            yield given(*map(list, zip(*done))) if done else given([], [])
        if running is not None:
            yield given([current], [running.hexdigest()])

    ordered = repaired.repartition("conv").sortWithinPartitions("conv", "spot", "step")
    return ordered.select("conv", "role", "text").mapInArrow(digest, "conv string, repaired_sha256 string")


def repair_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv, spot, step, role, text`` of the repaired conversations, and a report
    ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of those with rows.
    ``conv`` is the text of ``conv_id`` after an equals sign, empty for a null id."""
    rows = turns(conversations)
    marked = faults(rows)
    cut = pieces(marked)
    states, illegal = _states(cut)
    edited = _edited(cut, states)

    counted = marked.groupBy("conv").agg(
        *(F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")),
        (F.max("turn") - F.min("turn") + 1).alias("_span"),
    )
    told = marked.filter(F.col("turn").isNotNull()).select("conv", "turn").distinct().groupBy("conv").agg(F.count(F.lit(1)).alias("_turns"))
    parts = F.array_sort(F.collect_list(F.struct("spot", "audit")))
    audits = edited.groupBy("conv").agg(
        F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"),
        F.array_join(F.transform(parts, lambda part: part["audit"]), "").alias("audit"),
    )
    report = counted.join(told, "conv", "left").join(audits, "conv").join(illegal, "conv", "left").select(
        "conv", F.coalesce(F.col("_span") - F.col("_turns"), F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        F.coalesce("all_illegal", "illegal").alias("illegal"), "cost", "audit",
    )
    return repaired_rows(edited, rows), report


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults that the CRC-32 of ``conv_id:turn``
    chooses: rows lost, emptied, without endings, said twice, or given to the user."""
    name = F.concat(*(F.coalesce(F.col(one).cast("string"), F.lit(" ")) if one else F.lit(":") for one in ("conv_id", "", "turn")))
    role, text = (F.coalesce(F.col(one).cast("string"), F.lit(" ")) for one in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name) % 20).alias("_fault"))
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", ENDINGS, "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.filter("_fault <> 0").select(
        "conv_id", "turn", F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("_copy")
    ).drop("_copy")
