"""Secret scan: spans of credentials, with weak parts linked across a scope.

Strong patterns are reported alone. Weak ones (a login name, a key-shaped run,
an address) say nothing by themselves; they are reported only when the parts
that complete a credential lie within reach in the same document, found by an
interval join on position bins.

Defined results. A null text is empty. Positions are code points, ends are
exclusive. Repeated rows with equal id and text have equal spans and a null id
is an id like any other; equal spans of one kind occur once. Other columns are
ignored. Texts are scanned whole; an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailrisk.llm.common import prefixed, same_row
from mailrisk.session import new_stage, write_stage

IDENTIFIER, SECRET, ENDPOINT = "identifier", "secret", "endpoint"


@dataclass(frozen=True)
class Kind:
    """One pattern. ``valued`` is the group that ``accepts`` judges; a match it
    rejects is dropped after matching, so it still hides later text it took."""

    name: str
    role: str
    pattern: str
    valued: int
    accepts: Callable[[Column], Column]
    weak: bool = False


# The three base patterns. Runs shorter than the limit cannot hold
# a longer one, so counting repetitions in the pattern finds the same spans as
# matching every run, without a match per letter.
KINDS = (
    Kind(
        "assign", SECRET,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2,
        lambda value: F.length(value) >= 8,
    ),
    Kind("access", IDENTIFIER, "AKIA[A-Z0-9]{12,}", 0, lambda value: F.lit(True)),
    Kind("hex", SECRET, "[0-9a-f]{32,}", 0, lambda value: F.lit(True)),
    Kind(
        "login", IDENTIFIER,
        r"""(?i:user_?name|user_?id|login|client_?id|account_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""", 1,
        lambda value: F.length(value) >= 3, weak=True,
    ),
    Kind(
        "key", SECRET, "[A-Za-z0-9+/]{40,}", 0,
        lambda value: (F.length(value) == 40) & value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]"),
        weak=True,
    ),
    Kind("endpoint", ENDPOINT, r"""https?://[^\x20\x09-\x0D"'<>]+""", 0, lambda value: F.lit(True), weak=True),
)
BASE = ("assign", "access", "hex")
_WORDS = (
    "password", "passwd", "secret", "token", "apikey", "api_key", "username", "user_name", "userid", "user_id",
    "login", "clientid", "client_id", "accountid", "account_id", "http",
)
#: What a weak span of a role needs within reach.
NEEDS = {IDENTIFIER: (SECRET,), SECRET: (IDENTIFIER,), ENDPOINT: (IDENTIFIER, SECRET)}


def _suspects(documents: DataFrame) -> DataFrame:
    """Rows in which some pattern can match; plain substring searches come first."""
    text = F.col("text")
    lowered = F.lower(text)
    possible = text.contains("AKIA") | text.rlike("[0-9a-f]{32,}") | text.rlike("[A-Za-z0-9+/]{40,}")
    for word in _WORDS:
        possible = possible | F.contains(lowered, F.lit(word))
    return documents.filter(possible).select("doc_id", F.xxhash64("text").alias("_copy"), "text")


def _matches(suspects: DataFrame, kind: Kind) -> DataFrame:
    """Matches of one kind with the length of the text since the previous one."""
    text = F.col("text")
    found = F.arrays_zip(
        F.transform(F.split(text, kind.pattern, -1), F.length).alias("gap"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.valued)).alias("value"),
    )
    return suspects.select("doc_id", "_copy", F.posexplode(found).alias("_at", "_found")).select(
        "doc_id", "_copy", F.lit(kind.name).alias("kind"), F.lit(kind.role).alias("role"),
        F.lit(kind.weak).alias("weak"), "_at", F.col("_found.gap").cast("long").alias("_gap"),
        F.col("_found.match").alias("value"), kind.accepts(F.col("_found.value")).alias("_accepted"),
    ).filter(F.col("value").isNotNull())


def candidate_spans(documents: DataFrame) -> DataFrame:
    """``doc_id, _copy, kind, role, weak, start, end, value`` of every accepted match."""
    suspects = new_stage(_suspects(documents), "suspects")
    found = None
    for kind in KINDS:
        rows = _matches(suspects.rows, kind)
        found = rows if found is None else found.unionByName(rows)
    once = found.groupBy("doc_id", "_copy", "kind", "role", "weak", "_at").agg(
        F.first("_gap").alias("_gap"), F.first("value").alias("value"), F.first("_accepted").alias("_accepted")
    )
    so_far = Window.partitionBy("doc_id", "_copy", "kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("value").cast("long")
    placed = once.withColumn("end", F.sum(F.col("_gap") + size).over(so_far))
    spans = write_stage(
        placed.filter("_accepted").select(
            "doc_id", "_copy", "kind", "role", "weak", (F.col("end") - size).alias("start"), "end", "value"
        ),
        "spans",
    )
    suspects.remove()
    return spans


def _in_bins(spans: DataFrame, reach: int, ahead: int = 0) -> DataFrame:
    """One row per bin of ``reach`` code points that a span, widened by ``ahead``, touches."""
    first = F.floor((F.col("start") - ahead) / reach)
    last = F.floor((F.col("end") + ahead) / reach)
    return spans.withColumn("_bin", F.explode(F.sequence(first, last)))


def _same_bin() -> Column:
    """Same document and bin, for a table joined with a ``prefixed`` one."""
    return (
        F.col("doc_id").eqNullSafe(F.col("o_doc_id"))
        & (F.col("_copy") == F.col("o__copy")) & (F.col("_bin") == F.col("o__bin"))
    )


def _nearby(reach: int) -> Column:
    """At most ``reach`` code points between the spans."""
    return (F.col("o_start") <= F.col("end") + reach) & (F.col("o_end") + reach >= F.col("start"))


def linked_spans(spans: DataFrame, reach: int = 200) -> DataFrame:
    """Strong spans, and the weak ones whose complementary parts are within reach.

    Bins bound the pairs by the length of the text, and only their existence is
    asked for (a semi-join), so a document full of candidates yields no pairs.
    A weak span inside a strong one of the same role is that one's and is left out.
    """
    strong = spans.filter(~F.col("weak"))
    parts = prefixed(_in_bins(spans.select("doc_id", "_copy", "role", "weak", "start", "end"), reach), "o_")
    # The bin of a weak span's start is one that a span around it touches too.
    weak = spans.filter("weak").withColumn("_bin", F.floor(F.col("start") / reach))
    inside = (
        _same_bin() & (F.col("role") == F.col("o_role"))
        & (F.col("o_start") <= F.col("start")) & (F.col("end") <= F.col("o_end"))
    )
    fresh = weak.join(parts.filter(~F.col("o_weak")), inside, "left_anti").drop("_bin")
    kept = strong
    for role, needed in NEEDS.items():
        rows = fresh.filter(F.col("role") == role)
        for part in needed:
            sought = parts.filter(F.col("o_role") == part)
            rows = _in_bins(rows, reach, reach).join(sought, _same_bin() & _nearby(reach), "left_semi")
            rows = rows.drop("_bin").distinct()
        kept = kept.unionByName(rows)
    return kept


def credentials(spans: DataFrame, reach: int = 200) -> DataFrame:
    """``doc_id, _copy, identifier, secret``: per identifier of ``linked_spans``
    the nearest secret within reach, as structs ``(kind, start, end, value)``.
    Identifiers without one are left out; ties go to the earlier secret."""
    part = F.struct("kind", "start", "end", "value")
    named = spans.select("doc_id", "_copy", "role", "start", "end", part.alias("part"))
    left = _in_bins(named.filter(F.col("role") == IDENTIFIER), reach, reach)
    right = prefixed(_in_bins(named.filter(F.col("role") == SECRET), reach), "o_")
    gap = F.greatest(F.col("start") - F.col("o_end"), F.col("o_start") - F.col("end"), F.lit(0))
    pairs = left.join(right, _same_bin() & _nearby(reach)).withColumn("_order", F.struct(gap, F.col("o_start")))
    return pairs.groupBy("doc_id", "_copy", F.col("part").alias(IDENTIFIER)).agg(
        F.min_by("o_part", "_order").alias(SECRET)
    )


def scan_documents(documents: DataFrame, reach: int = 200) -> DataFrame:
    """``doc_id, spans`` for every row: ``spans`` is an array of structs
    ``(start, rank, kind, end, value)`` in order of start and kind."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rank = F.array_position(F.array(*(F.lit(kind.name) for kind in KINDS)), F.col("kind"))
    listed = (
        linked_spans(candidate_spans(rows), reach)
        .groupBy("doc_id", "_copy")
        .agg(F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end", "value"))).alias("spans"))
    )
    keyed = rows.select("doc_id", F.xxhash64("text").alias("_copy"))
    match = same_row(keyed, listed, "doc_id") & (keyed["_copy"] == listed["_copy"])
    nothing = F.array().cast(listed.schema["spans"].dataType)
    return keyed.join(listed, match, "left").select(
        keyed["doc_id"], F.coalesce(listed["spans"], nothing).alias("spans")
    )


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
