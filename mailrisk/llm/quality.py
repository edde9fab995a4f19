"""Quality rules: lines that many documents of a host share.

Normalised lines are hashed and counted once per distinct text and host. Lines
above the limits are removed, and documents of which too little is left are
rejected, next to the rules on length and repetition.

Defined results. Null and empty texts have no words and fail the base rules; a
null host is a host of its own. Repeated rows and exact copies of a text within
a host count as one document. Columns beyond those named below are ignored by
the signals and passed through by ``filter_documents``. Texts of any length are
read whole; an empty table gives empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailrisk.llm.common import BREAKS, covered, grams, spaced, split_words
from mailrisk.session import new_stage, write_stage

SYMBOLS = "#*$%&|<>"  # fixed value
WINDOW = 8
_PROBE = 4


@dataclass(frozen=True)
class LineRules:
    """Limits. A line goes when more than ``max_documents`` distinct texts and
    more than ``max_share`` of the host's distinct texts hold it; a document
    goes when removed lines held more than ``max_removed`` of its words. A share
    grows with the host, so by default the count of texts alone decides."""

    min_words: int = 20
    max_repeat_percent: int = 30
    max_documents: int = 10
    max_share: float = 0.0
    max_removed: float = 0.7


def _with_lines(rows: DataFrame) -> DataFrame:
    """Adds ``_lines``, lower case with single spaces; blank lines stay in place
    as empty strings, so that positions equal those of the raw lines."""
    inner = BREAKS.replace("\n", "")
    single = F.regexp_replace(F.lower(spaced(F.col("_text"), inner)), " {2,}", " ")
    return rows.withColumn("_lines", F.transform(F.split(single, "\n"), lambda line: F.trim(line)))


def _key(line: Column) -> Column:
    """Hash of a normalised line; null for a line without words."""
    return F.when(line != "", F.xxhash64(line))


def _plain(documents: DataFrame, host: str) -> DataFrame:
    return documents.select(
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"),
        F.coalesce(F.col("text"), F.lit("")).alias("_text"),
    )


def frequent_lines(documents: DataFrame, rules: LineRules = LineRules(), host: str = "source") -> DataFrame:
    """Hashes of the lines above the limits: ``(_host, _over)`` with a share,
    ``(_host, _copy, _over)`` for each distinct text that holds any without one.

    A share leaves a host at most ``1 / max_share`` times its mean number of
    distinct lines per text, so one array per host is small. Without one the
    lines grow with the host and are joined back to its texts. Counting is a sum
    with map-side combining over distinct texts; a hot host or line is spread
    over all tasks.
    """
    hashed = _with_lines(_plain(documents, host)).select(
        "_host",
        F.xxhash64("_text").alias("_copy"),
        F.array_compact(F.array_distinct(F.transform("_lines", _key))).alias("_keys"),
    )
    texts = new_stage(hashed.groupBy("_host", "_copy").agg(F.first("_keys").alias("_keys")), "lines")
    held = texts.rows.select("_host", "_copy", F.explode("_keys").alias("_key"))
    over = (
        held.groupBy("_host", "_key").agg(F.count(F.lit(1)).alias("_holding"))
        .filter(F.col("_holding") > rules.max_documents)
    )
    if rules.max_share > 0:
        sizes = texts.rows.groupBy("_host").agg(F.count(F.lit(1)).alias("_texts"))
        over = over.join(sizes, "_host").filter(F.col("_holding") > F.col("_texts") * rules.max_share)
        listed = over.groupBy("_host").agg(F.collect_set("_key").alias("_over"))
    else:
        found = held.join(over.select("_host", "_key"), ["_host", "_key"])
        listed = found.groupBy("_host", "_copy").agg(F.collect_list("_key").alias("_over"))
    result = write_stage(listed, "frequent_lines")
    texts.remove()
    return result


def _repeated(rows: DataFrame) -> DataFrame:
    """Adds ``_repeat``: words inside 8-word windows that occur twice or more.

    A repeated window repeats five 4-word windows. Counting those first, which
    costs half as much, settles most texts; only the others hash and sort all
    their 8-word windows. Nothing leaves the row.
    """
    probed = rows.withColumn("_probe", grams("_words", _PROBE))
    doubtful = F.size("_probe") - F.size(F.array_distinct("_probe")) > WINDOW - _PROBE
    long_enough = F.size("_words") > WINDOW
    hashed = probed.withColumn(
        "_grams",
        F.when(doubtful & long_enough, F.slice(grams("_words", WINDOW), F.lit(1), F.size("_words") - (WINDOW - 1))),
    ).drop("_probe")
    ordered = hashed.withColumn(
        "_ordered",
        F.when(
            F.size("_grams") > F.size(F.array_distinct("_grams")),
            F.sort_array(F.transform("_grams", lambda gram, at: F.struct(gram.alias("gram"), at.alias("at")))),
        ),
    ).drop("_grams")

    def has_twin(item: Column, at: Column) -> Column:
        before = (at > 0) & (F.get(F.col("_ordered"), at - 1)["gram"] == item["gram"])
        after = F.get(F.col("_ordered"), at + 1)["gram"] == item["gram"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    starts = F.sort_array(F.transform(F.filter("_ordered", has_twin), lambda item: item["at"].cast("long")))
    spans = F.transform(starts, lambda at: F.struct(at.alias("start"), (at + WINDOW).alias("end")))
    return ordered.withColumn("_spans", spans).withColumn(
        "_repeat", F.coalesce(covered(F.col("_spans")), F.lit(0).cast("long"))
    ).drop("_ordered", "_spans")


def with_signals(documents: DataFrame, over: DataFrame, rules: LineRules = LineRules(), host: str = "source") -> DataFrame:
    """All columns of ``documents`` and a struct ``quality``, which replaces a
    column of that name.

    Fields: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_removed_lines, n_removed_words, left`` (the text without the
    removed lines) and ``kept``. ``over`` with one small row per host is
    broadcast when its written size allows and otherwise joined on the host; with
    one row per text it grows with the input and is joined on host and text by
    sorting. Adaptive execution splits a hot key of either.
    """
    rows = documents.select(
        F.struct(*(F.col(f"`{name}`") for name in documents.columns if name != "quality")).alias("_row"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_copy"),
    )
    by_text = "_copy" in over.columns
    keys = ["_host", "_copy"] if by_text else ["_host"]
    joined = rows.join(over.hint("merge") if by_text else over, keys, "left").withColumn("_text", F.coalesce("_row.text", F.lit("")))
    counted = _repeated(joined.withColumn("_words", split_words(F.col("_text"))))
    raw = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    measured = counted.withColumn("_raw", raw).select(
        "_row", "_text", "_over",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("_raw") - F.size(F.array_distinct("_raw"))).cast("long").alias("n_dup_lines"),
        F.col("_repeat").alias("n_repeat_words"),
    )
    lined = _with_lines(measured)

    def is_over(at: Column) -> Column:
        return F.coalesce(F.array_contains("_over", _key(F.get(F.col("_lines"), at))), F.lit(False))

    some = F.col("_over").isNotNull()
    removed = F.when(some, F.filter(F.split("_text", "\n"), lambda _, at: is_over(at)))
    stayed = F.when(some, F.filter(F.split("_text", "\n"), lambda _, at: ~is_over(at)))
    parted = lined.withColumns({"_removed": removed, "_stayed": stayed}).drop("_lines")
    n_removed = F.size(split_words(F.array_join("_removed", "\n"))).cast("long")
    base_failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent
    )
    judged = parted.withColumns({
        "base_failed": base_failed,
        "n_removed_lines": F.coalesce(F.size("_removed"), F.lit(0)).cast("long"),
        "n_removed_words": F.when(F.size("_removed") > 0, n_removed).otherwise(0).cast("long"),
        "left": F.when(F.size("_removed") > 0, F.array_join("_stayed", "\n")).otherwise(F.col("_text")),
    })
    depleted = F.col("n_removed_words") > F.col("n_words") * rules.max_removed
    fields = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "n_removed_lines", "n_removed_words", "left",
    )
    return judged.select(
        "_row.*", F.struct(*fields, (~F.col("base_failed") & ~depleted).alias("kept")).alias("quality")
    )


def judge_documents(documents: DataFrame, rules: LineRules = LineRules(), host: str = "source") -> DataFrame:
    """``documents`` with their quality struct, counted over all of them."""
    return with_signals(documents, frequent_lines(documents, rules, host), rules, host)


def filter_documents(documents: DataFrame, rules: LineRules = LineRules(), host: str = "source") -> DataFrame:
    """The documents that pass, without the removed lines. A column ``n_chars``
    follows the shortened text; a null text never passes."""
    given = F.struct(F.lit(None).cast("string").alias("_"), *(F.col(f"`{name}`") for name in documents.columns if name not in ("text", "n_chars")))
    judged = judge_documents(documents.select(given.alias("given"), "text", F.col(host).alias("host")), rules, "host")
    # Written before filtering: a pushed-down filter would repeat all measures per word.
    done = write_stage(judged.select("given", "quality.kept", "quality.left"), "judged")
    changed = {"text": F.col("left")}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.length("left").cast(documents.schema["n_chars"].dataType)
    columns = (changed.get(name, F.col(f"given.`{name}`")).alias(name) for name in documents.columns)
    return done.filter("kept").select(*columns)
