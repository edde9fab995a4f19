"""Headers, labels, duplicates, conflicts and CSV folders."""

from __future__ import annotations

import csv as python_csv
import io
import random

import pytest
from pyspark.sql import functions as F

from mailrisk.functions.labels import numeric_label
from mailrisk.operators import dedup, standardize
from mailrisk.plans import training
from mailrisk.plans.standardization import standardize as run
from mailrisk.sources import csv, tables


def test_header_normalization():
    assert standardize.normalize_headers([" Sent-Date", "Email  Subject", "Label", "label", "__x__"]) == [
        "sent_date", "email_subject", "label", "label_2", "x",
    ]
    assert standardize.find_header(["body", "message"], "body") == "body"
    assert standardize.find_header(["x"], "body") is None


def feed(spark, rows):
    return spark.createDataFrame(rows, "_row_key long, _source_file string, text string, label string")


ROWS = [
    (1, "a.csv", "hello", "0"), (2, "a.csv", "hello", "0"), (3, "b.csv", "hello", "ham"),
    (4, "a.csv", "win", "1"), (5, "a.csv", "win", "0"), (6, "a.csv", "n/a", "1"), (7, "a.csv", "ok", None),
]


@pytest.mark.parametrize("partitions", [1, 3])
def test_dedup_and_summary(spark, partitions):
    result = run(spark, [feed(spark, ROWS).repartition(partitions)])
    assert [(r.row_key, r.source_file) for r in result.mails.collect()] == [(1, "a.csv")]
    assert dict(result.summary.collect()) == {
        "rows_before_cleaning": 7, "rows_after_load": 7, "rows_after_cleaning": 1,
        "duplicate_rows_removed": 2, "conflicting_texts_removed": 1, "conflicting_rows_removed": 2,
        "label_0": 1, "label_1": 0,
    }
    again = dedup.deduplicate(result.mails)
    assert again.count() == result.mails.count()


def test_feed_without_label_or_feeds(spark):
    unlabelled = spark.createDataFrame([(1, "f", "s", "b")], "_row_key long, _source_file string, Subject string, Body string")
    standard = standardize.standardize_feed(unlabelled)
    assert standard.first()["text_combined"] == "s b"
    assert standardize.usable_rows(standard).count() == 0
    assert standardize.standardize_feeds(spark, []).columns == ["row_key", *standardize.MAIL_COLUMNS]


def test_loading_guards(spark):
    with pytest.raises(ValueError, match="Missing required columns"):
        tables.load_for_training(spark.createDataFrame([("x",)], "text_combined string"))
    one_class = spark.createDataFrame([("x", "1"), ("y", "1")], "text_combined string, label string")
    with pytest.raises(ValueError, match="two examples"):
        tables.require_two_classes(tables.load_for_training(one_class))


def test_csv_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_bytes(
        b"\xef\xbb\xbfsubject,body,label\n"
        b'hi,"two\nlines, ""quoted""",spam\n'
        b"short row\n"
        b"too,many,0,fields\n"
        b"NULL,caf\xc3\xa9,0\n"
    )
    (tmp_path / "sub" / "b c+[1]%.csv").write_bytes(b"Subject,Message,Class\ncaf\xe9,x,ham\n")
    feeds = csv.read_feeds(spark, str(tmp_path))
    mails = standardize.standardize_feeds(spark, feeds).orderBy("row_key").collect()
    got = [(r.source_file, r.subject, r.body, r.label) for r in mails]
    assert got == [
        ("a.csv", "hi", 'two\nlines, "quoted"', 1),
        ("a.csv", "short row", "", None),
        ("a.csv", "", "café", 0),
        ("b c+[1]%.csv", "café", "x", 0),
    ]
    (tmp_path / "empty").mkdir()
    assert csv.read_feeds(spark, str(tmp_path / "empty")) == []


def test_headers_with_line_breaks_and_the_last_encoding(spark, tmp_path):
    (tmp_path / "breaks.csv").write_bytes(b'subject,"bo\ndy",label,message\nhi,x,spam,"first\nsecond"\nyo,y,ham,m\n')
    (tmp_path / "latin.csv").write_bytes(b"subject,message,label\ncaf\xe9 \x81\x93x,text,1\n")
    (tmp_path / "windows.csv").write_bytes(b"subject,message,label\ncaf\xe9 \x93x,text,1\n")
    (tmp_path / "bom.csv").write_bytes("﻿subject,message,label\nÁ,text,0\n".encode())
    rows = {}
    for feed in csv.read_feeds(spark, str(tmp_path)):
        for row in feed.orderBy("_row_key").collect():
            rows.setdefault(row["_source_file"], []).append(row.asDict())
    assert [r["subject"] for r in rows["breaks.csv"]] == ["hi", "yo"] and rows["breaks.csv"][0]["message"] == "first\nsecond"
    assert "bo\ndy" in rows["breaks.csv"][0]
    assert rows["latin.csv"][0]["subject"] == "caf\xe9 \x81\x93x"
    assert rows["windows.csv"][0]["subject"] == "caf\xe9 “x"
    assert rows["bom.csv"][0]["subject"] == "Á"


def test_only_decimal_numbers_are_labels(spark):
    values = ["1", " 1.0 ", "0", "-0", "1e0", ".0", "1d", "1f", "0x1p0", "NaN", "inf", "", None, "2", "1_0"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, label string")
    got = [r[0] for r in rows.select("i", numeric_label(F.col("label")).alias("n")).orderBy("i").select("n").collect()]
    assert got == [1, 1, 0, 0, 1, 0, None, None, None, None, None, None, None, None, None]
    assert spark.range(3).select(numeric_label(F.col("id"))).collect() == [(0,), (1,), (None,)]


def test_stored_tables_get_row_keys(spark, tmp_path):
    rows = [("first text", 1), ("second text", 0), ("second text", 0)]
    table = spark.createDataFrame(rows, "text_combined string, label int").repartition(3)
    table.write.parquet(str(tmp_path / "plain"))
    read = tables.read_canonical(spark, str(tmp_path / "plain"))
    keys = [r.row_key for r in read.collect()]
    assert len(set(keys)) == 3 and sorted((r.text_combined, r.label) for r in read.collect()) == rows
    assert sorted(r.row_key for r in tables.read_canonical(spark, str(tmp_path / "plain")).collect()) == sorted(keys)
    table.coalesce(1).write.csv(str(tmp_path / "csv"), header=True)
    assert len({r.row_key for r in tables.read_canonical(spark, str(tmp_path / "csv")).collect()}) == 3
    with pytest.raises(ValueError, match="row_key"):
        training.train(table)
    spark.createDataFrame([(5, "x", 1)], "row_key long, text_combined string, label int").write.parquet(str(tmp_path / "keyed"))
    assert tables.read_canonical(spark, str(tmp_path / "keyed")).first().row_key == 5


def random_records(chance, n):
    cells = ["plain", "", '5" disk', "a\nb", "x\r\ny", 'say "hi"', "comma, inside", "line\n" * 40, '"', "\n\n\n", "ü"]
    return [[f"r{at}", chance.choice(cells), chance.choice(cells)] for at in range(n)]


def as_csv(chance, records, end):
    def cell(value):
        special = any(c in value for c in ",\r\n") or value.startswith('"')
        return '"' + value.replace('"', '""') + '"' if special or chance.random() < 0.2 else value

    return "".join(",".join(map(cell, record)) + end for record in records)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("split_bytes", [60, 1000])
def test_large_files_are_cut_at_true_record_ends(spark, tmp_path, end, split_bytes):
    chance = random.Random(split_bytes)
    expected = {}
    for name in ("b", "a"):
        records = random_records(chance, 60)
        records[50] = ["r50", "over", "x", "y"]
        if end == "\r":  # such files have no breaks but those between records
            records = [[value.replace("\r", "").replace("\n", " ") for value in record] for record in records]
        text = as_csv(chance, [["id", "one", "two"], *records], end)
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
        expected[f"{name}.csv"] = [
            tuple(value or None for value in row) for row in list(python_csv.reader(io.StringIO(text, newline="")))[1:] if len(row) == 3
        ]
    settings = {"spark.sql.files.maxPartitionBytes": str(split_bytes), "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        assert csv._lines(spark, str(tmp_path)).rdd.getNumPartitions() > (4 if end != "\r" else 1)
        (feed,) = csv.read_feeds(spark, str(tmp_path))
        rows = feed.orderBy("_row_key").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert [r["_source_file"] for r in rows] == sorted(r["_source_file"] for r in rows)
    for name, wanted in expected.items():
        assert [(r["id"], r["one"], r["two"]) for r in rows if r["_source_file"] == name] == wanted


@pytest.mark.parametrize("line,outside,inside", [
    (b"a,b", False, True), (b'a,"b', True, False), (b'a"b,c', False, False), (b'"a""', True, False), (b'"a"",b', True, False),
    (b'a","b', True, True), (b'a",b"', False, False), (b'"",""', False, True), (b'"', True, False), (b'x"y"z,"q', True, True),
])
def test_state_of_a_line(line, outside, inside):
    assert (csv.ends_inside(line, False), csv.ends_inside(line, True)) == (outside, inside)
