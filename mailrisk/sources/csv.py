"""Read folders of labelled mail CSV files with differing headers and encodings.

Files of any size are read by many tasks, line by line, although a quoted cell may
hold line breaks. A line is a function from "begins inside a quoted cell or not" to
"ends inside one or not"; such functions are composed per byte split, and a scan
over the splits of each file tells how every split begins (where quotes only stand
around and inside quoted cells this is the parity of their number). A second scan
then cuts every split into records; the few that cross splits are joined
afterwards. Headers and encodings are taken from the written records, in one
grouping by file, and files that agree in both are one feed of string columns. No
list of files or headers by file comes to the driver.
"""

from __future__ import annotations

import csv
import hashlib
import io
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailrisk.operators.standardize import ROW_KEY, SOURCE
from mailrisk.session import ship_with_tasks, write_stage

ship_with_tasks(__name__)

# Encodings in order of preference, bytes that the second does not
# define, cell texts read as missing.
UTF8, WINDOWS, LATIN = "UTF-8", "windows-1252", "ISO-8859-1"
UNDEFINED_WINDOWS = (0x81, 0x8D, 0x8F, 0x90, 0x9D)
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
_RAW = "_raw_record"
# A file may have 2**40 bytes: a record's place in it stays below its first byte.
_PLACE_BITS = 40
# A record that lies in one split, and pieces of others: begun, passed through, ended.
_WHOLE, _BEGUN, _THROUGH, _ENDED = range(4)

_QUOTED = rb'[^"]*+(?:""[^"]*+)*+'  # up to a closing quote or the end
_ENDS_OPEN = re.compile(rb'(?:(?:"' + _QUOTED + rb'"[^,]*+|[^",][^,]*+|),)*+"' + _QUOTED + rb"\Z")
_CLOSES = re.compile(_QUOTED + rb'"[^,]*+')
_CELL = rb'(?:"' + _QUOTED + rb'(?:"[^,\r]*+|\Z)|[^",\r][^,\r]*+|)'
_TO_RETURN = re.compile(_CELL + rb"(?:," + _CELL + rb")*+")


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a line that begins inside a quoted cell, or at a record's start, ends inside one.

    Only a quote at the start of a cell opens it; quotes elsewhere in an unquoted
    cell, or after the closing one, are text.
    """
    if b'"' not in line:
        return inside
    if inside:
        closed = _CLOSES.match(line)
        if closed is None:
            return True
        if closed.end() == len(line):
            return False
        line = line[closed.end() + 1 :]
    return _ENDS_OPEN.match(line) is not None


def _lines(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``location, block, line`` (bytes) of the matching files below a folder. A split's lines
    arrive one after another; ``block`` is its first byte."""
    lines = (
        spark.read.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        .option("lineSep", "\n").load(folder)
    )
    return lines.select(
        F.col("_metadata.file_path").alias("location"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in ("location", "block", "line")))


def _split_name(location: str, block: int) -> bytes:
    return hashlib.blake2b(f"{block} {location}".encode(), digest_size=8).digest()


def _inner_splits(lines: DataFrame) -> frozenset[bytes]:
    """Names of the splits that begin inside a quoted cell: eight bytes for each of
    them, a small share of one for every 128 MB of input."""
    schema = "location string, block long, from_outside boolean, from_inside boolean"

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, ends = None, []
        for location, block, line in _rows(batches):
            if (location, block) != split:
                if split is not None:
                    yield told(split, ends)
                split, ends = (location, block), [False, True]
            if b'"' in line:
                ends = [ends_inside(line, end) for end in ends]
        if split is not None:
            yield told(split, ends)

    def told(split: tuple[str, int], ends: list[bool]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([value]) for value in (*split, *ends)], names=["location", "block", "from_outside", "from_inside"]
        )

    def scan(splits: pa.Table) -> pa.Table:
        inside, found = False, {"location": [], "block": []}
        for row in sorted(splits.to_pylist(), key=lambda row: row["block"]):
            if inside:
                found["location"].append(row["location"])
                found["block"].append(row["block"])
            inside = row["from_inside"] if inside else row["from_outside"]
        return pa.table(found, schema=pa.schema([("location", pa.string()), ("block", pa.int64())]))

    composed = lines.mapInArrow(compose, schema)
    inner = composed.groupBy("location").applyInArrow(scan, "location string, block long").collect()
    return frozenset(_split_name(row["location"], row["block"]) for row in inner)


def _at_returns(record: bytes) -> list[bytes]:
    """A record cut at carriage returns outside quotes; they end records like line feeds."""
    record = record.removesuffix(b"\r")
    if b"\r" not in record:
        return [record] if record else []
    found, at = [], 0
    while at < len(record):
        match = _TO_RETURN.match(record, at)
        found.append(match.group())
        at = match.end() + 1
    return [one for one in found if one]


def read_records(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``location, place, record`` (bytes) of all records that are not empty, headers
    included; ``place`` grows with the position in the file."""
    lines = _lines(spark, folder, pattern)
    inner = _inner_splits(lines)
    schema = "location string, place long, kind int, record binary"
    names = ["location", "place", "kind", "record"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, number, inside, begun, held, out = None, 0, False, True, [], []

        def put(kind: int) -> None:
            place, text = split[1] + number - len(held), b"\n".join(held)
            for at, record in enumerate(_at_returns(text) if kind == _WHOLE else [text]):
                out.append((split[0], place + at, kind, record))
            held.clear()

        def packed() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 4
            out.clear()
            types = (pa.string(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for location, block, line in _rows(batches):
            if (location, block) != split:
                if held:
                    put(_BEGUN if begun else _THROUGH)
                split, number = (location, block), 0
                inside = _split_name(location, block) in inner
                begun = not inside
            inside = ends_inside(line, inside)
            held.append(line)
            number += 1
            if not inside:
                put(_WHOLE if begun else _ENDED)
                begun = True
            if len(out) >= 2_000:
                yield packed()
        if held:
            put(_BEGUN if begun else _THROUGH)
        yield packed()

    def join(pieces: pa.Table) -> pa.Table:
        found: list[list] = []
        for row in sorted(pieces.to_pylist(), key=lambda row: row["place"]):
            if row["kind"] == _BEGUN or not found:
                found.append([row["location"], row["place"], row["record"]])
            else:
                found[-1][2] += b"\n" + row["record"]
        rows = [(location, place, record.removesuffix(b"\r")) for location, place, record in found]
        types = pa.schema([("location", pa.string()), ("place", pa.int64()), ("record", pa.binary())])
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)

    pieces = write_stage(lines.mapInArrow(cut, schema), "csv-records")
    whole = pieces.where(F.col("kind") == _WHOLE).drop("kind")
    crossing = pieces.where(F.col("kind") != _WHOLE).groupBy("location").applyInArrow(join, "location string, place long, record binary")
    return whole.unionByName(crossing)


def _path_order(location: Column) -> Column:
    """The path that a reported location stands for; a plus sign is no blank there."""
    return F.url_decode(F.replace(location, F.lit("+"), F.lit("%2B")))


def file_facts(records: DataFrame) -> DataFrame:
    """Written ``location, position, source, header, header_place, encoding``, one row per
    file with records. A file that is not UTF-8 is read as Windows-1252, or as
    Latin-1 if it has a byte which that leaves undefined."""
    undefined = F.lit(False)
    for byte in UNDEFINED_WINDOWS:
        undefined = undefined | F.contains("record", F.lit(bytes([byte])))
    facts = records.groupBy("location").agg(
        F.min_by("record", "place").alias("header"), F.min("place").alias("header_place"),
        F.bool_or(~F.is_valid_utf8(F.col("record").cast("string"))).alias("other"), F.bool_or(undefined).alias("undefined"),
    )
    encoding = F.when(~F.col("other"), UTF8).when(F.col("undefined"), LATIN).otherwise(WINDOWS)
    path = _path_order(F.col("location"))
    return write_stage(
        facts.select(
            "location", (F.row_number().over(Window.orderBy(path)) - 1).cast("long").alias("position"),
            F.element_at(F.split(path, "/"), -1).alias("source"), "header", "header_place", encoding.alias("encoding"),
        ),
        "csv-files",
    )


def _cells(header: bytes, encoding: str) -> tuple[str, ...]:
    """Cells of a header record, which may hold line breaks."""
    text = header.decode(encoding, "replace").lstrip("\ufeff")
    return tuple(next(csv.reader(io.StringIO(text, newline="")), ()))


def allow_windows_encoding(spark: SparkSession) -> None:
    """Let the session read and write Windows-1252."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def _field_count(record: Column) -> Column:
    """Fields of a raw record: separators outside quoted fields, plus one."""
    bare = F.regexp_replace(record, r'(?s)(\A|,)"(?:[^"]|"")*+"', "$1")
    return F.regexp_count(bare, F.lit(",")) + 1


def _feed(records: DataFrame, files: DataFrame, header: tuple[str, ...], encoding: str) -> DataFrame:
    """One feed from files that share header and encoding.

    Short rows are filled with nulls; rows with too many fields are skipped.
    ``_row_key`` increases with the sorted file path and the place in the file.
    """
    names = [f"c{i}" for i in range(len(header))]
    schema = ", ".join(f"{name} string" for name in [*names, _RAW])
    options = {
        "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW, "multiLine": "true",
        "maxCharsPerColumn": "-1", "maxColumns": str(max(20_480, len(header) + 1)),
    }
    rows = records.join(files.select("location", "position", "source", "header_place"), "location").where(
        F.col("place") > F.col("header_place")
    )
    # Named with a column of the files, so that records are parsed after this join, by their own feed.
    text = F.when(F.col("header_place").isNotNull(), F.decode("record", encoding))
    key = (F.shiftleft("position", _PLACE_BITS) + F.col("place")).alias(ROW_KEY)
    parsed = rows.select(key, F.col("source").alias(SOURCE), F.from_csv(text, schema, options).alias("cells")).select(
        ROW_KEY, SOURCE, "cells.*"
    )
    fitting = parsed.where(F.col(_RAW).isNull() | (_field_count(F.col(_RAW)) <= len(header)))
    cells = [F.when(~F.col(name).isin(*MISSING_CELLS), F.col(name)).alias(name) for name in names]
    return fitting.select(ROW_KEY, SOURCE, *cells).toDF(ROW_KEY, SOURCE, *header)


def read_feeds(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[DataFrame]:
    """All matching files below a folder, as one feed per header and encoding."""
    allow_windows_encoding(spark)
    records = read_records(spark, folder, pattern)
    files = file_facts(records)
    kinds = files.groupBy("header", "encoding").agg(F.min("position").alias("first")).orderBy("first").collect()
    same: dict[tuple, list[bytes]] = defaultdict(list)
    for kind in kinds:  # one row per distinct header
        same[_cells(bytes(kind["header"]), kind["encoding"]), kind["encoding"]].append(bytes(kind["header"]))
    return [
        _feed(records, files.where(F.col("header").isin(*headers) & (F.col("encoding") == encoding)), cells, encoding)
        for (cells, encoding), headers in same.items()
    ]
