"""Column expressions and joins that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# White space is U+0020 and U+0009 to U+000D, nothing else.
BREAKS = "\t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def spaced(text: Column, breaks: str = BREAKS) -> Column:
    """``text`` (null: empty) with every white space character as a space."""
    result = F.coalesce(text, F.lit(""))
    for character in breaks:
        result = F.replace(result, F.lit(character), F.lit(" "))
    return result


def split_words(text: Column) -> Column:
    """Words between white space. Literal splitting is several times cheaper
    than a regular expression, and no lambda runs per word."""
    return F.array_remove(F.split(spaced(text), " "), "")


def grams(words: str, size: int) -> Column:
    """Hashes of the ``size`` consecutive words from each position on; the last
    ``size - 1`` positions, which lack words, give hashes of what is left.

    ``words`` names a column: an expression would run once per element.
    """
    return F.transform(
        words,
        lambda word, at: F.xxhash64(word, *(F.get(F.col(words), at + ahead) for ahead in range(1, size))),
    )


def covered(intervals: Column) -> Column:
    """Number of positions inside at least one of ``(start, end)`` intervals
    (long, end exclusive), which must be sorted."""
    state = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("reach"))
    merged = F.aggregate(
        intervals,
        state,
        lambda acc, span: F.struct(
            (acc["total"] + F.greatest(span["end"] - F.greatest(span["start"], acc["reach"]), F.lit(0))).alias("total"),
            F.greatest(acc["reach"], span["end"]).alias("reach"),
        ),
    )
    return merged["total"]


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns renamed, for joins of tables that come from the same one."""
    return df.select(*(F.col(f"`{name}`").alias(prefix + name) for name in df.columns))


def same_row(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of row keys: a null id equals a null id."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


PLACE_BITS = 33


def numbered(df: DataFrame, *order: Column | str) -> DataFrame:
    """Rows sorted by ranges, with ``_place``: the range in the upper bits, the
    row's number inside it in the lower ``PLACE_BITS``. No task sorts more than
    its range. To be written before use, as places are given on the fly."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.withColumn("_place", F.monotonically_increasing_id())


def overall(rows: DataFrame) -> DataFrame:
    """Written ``numbered`` rows with ``_overall``, their number from 0 on. What is
    summed up in one task are the ranges, one row each."""
    inside = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    ranges = rows.groupBy(F.shiftright("_place", PLACE_BITS).alias("_range")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")
    starts = ranges.select("_range", before.alias("_start"))
    return rows.withColumn("_range", F.shiftright("_place", PLACE_BITS)).join(starts, "_range").withColumn(
        "_overall", F.col("_start") + inside
    ).drop("_range", "_start")
