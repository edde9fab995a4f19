"""Golden values of the scalar expressions."""

from __future__ import annotations

import html
import json

import pytest
from pyspark.sql import functions as F

from mailrisk.functions import labels, links, risk, text
from mailrisk.functions.entities import decode_entities
from mailrisk.functions.mail import parse_mail


def values(spark, inputs, expression):
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, s string")
    return [r["v"] for r in rows.select("i", expression(F.col("s")).alias("v")).orderBy("i").collect()]


def test_normalize_label(spark):
    golden = {
        "1": 1, "1.0": 1, "0.0": 0, "-1": 1, " SPAM ": 1, "(ham)": 0, "True": 1, "no.": 0, "spam.0": 1,
        "_legit_": 0, "bad!": 1, "n/a": None, "<NA>": None, "": None, "1.5": None, "ph-ish": None, "2": None,
        None: None,
    }
    assert values(spark, golden, labels.normalize_label) == list(golden.values())


def test_listed_urls(spark):
    golden = {
        "['http://a.b','http://c.d']": 2, "http://a.b,http://c.d": 1, "a.com, b.com; 'none'|": 2,
        "{'a', 'b'}": 2, "x | y": 2, "0": 1, "[]": 0, "N/A": 0, None: 0,
    }
    assert values(spark, golden, links.count_listed_urls) == list(golden.values())


CLEANED = {
    "URGENT! Verify user@example.com at https://example.com in 24 hours.":
        ("urgent verify email at url in num hours", (1, 0, 0, 0, 1, 1)),
    "<b>FREE</b> $$$ call 555-1234 v2.0 abc123": ("free call num num v num abc", (0, 0, 2, 7, 1, 0)),
    "see http://10.0.0.1:8080/login or WWW.Foo.com/x) now": ("see url or url now", (2, 1, 0, 0, 1, 0)),
    "server 10.1.2.3": ("server num num", (0, 1, 0, 0, 0, 0)),
    "10.1.2.3/24 path": ("num num num path", (0, 1, 0, 0, 0, 0)),
    "é123 café 3.14": ("caf num", (0, 0, 0, 0, 0, 0)),
    "A_B AB ABC1 OK": ("a b ab abc ok", (0, 0, 0, 0, 2, 0)),
    " <a href='http://x.y/z'>CLICK HERE</a>!! ": ("click here", (1, 0, 2, 27, 2, 0)),
    "&lt;b&gt;x&amp;y": ("x y", (0, 0, 0, 0, 0, 0)),
    "": ("", (0, 0, 0, 0, 0, 0)),
}


def test_clean_text(spark):
    assert values(spark, CLEANED, text.clean_text) == [cleaned for cleaned, _ in CLEANED.values()]
    assert values(spark, [None], text.clean_text) == [""]


def test_markup_and_link_counts(spark):
    def counts(s):
        return F.array(
            links.count_feature_urls(s), links.has_ip_link(s).cast("int"), links.count_tags(s),
            links.tag_characters(s), links.count_upper_words(s), links.has_address(s).cast("int"),
        )

    found = values(spark, CLEANED, counts)
    assert [tuple(v) for v in found] == [counts for _, counts in CLEANED.values()]


def test_missing_values_and_strip(spark):
    assert values(spark, [None, " N/A ", "\tx y\xa0", "nan", "<na>", "nano"], text.clean_value) == [
        "", "", "x y", "", "", "nano",
    ]
    assert values(spark, [None, " N/A ", " x ", "  "], text.blank_if_missing) == ["", "", " x ", ""]


def test_entities_follow_html5(spark):
    samples = [
        "&amp;lt; &lt;b&gt;", "&notit; &not;", "&copy2024 &ampx &AMP", "&#150;&#x80;&#0;&#1114112;&#xD800;",
        "&#128512 ok &#xZ; & &; &zzz;", "&rsquo;&nbsp;x", "a && b &lt&gt", "&#39;q&#x27;",
        "&#00000000039;&#11;&#13;&#65535;&#99999999999;&#xfdd0;", "&NotEqualTilde;&frac12 &there4;&there4", "",
    ]
    assert values(spark, samples, decode_entities) == [html.unescape(s) for s in samples]


def test_parse_mail(spark):
    pasted = "Subject: Urgent account verification required\n\nFrom: Bob <b@x.io>\nsubject: second\nHi http://a.b/c now\n"
    rows = values(spark, [pasted, "Subject: \nhello", "subject: a"], lambda s: F.to_json(parse_mail(s)))
    first, second, third = map(json.loads, rows)
    assert first["subject"] == "Urgent account verification required"
    assert first["sender"] == "Bob <b@x.io>"
    assert first["body"] == "subject: second\nHi http://a.b/c now"
    assert first["urls"] == "http://a.b/c"
    assert second["subject"] == "" and second["body"] == "hello"
    # Without any other line the whole text is the body.
    assert third["subject"] == "a" and third["body"] == "subject: a"


@pytest.mark.parametrize(
    "score, level",
    [(0, "Low"), (39.999, "Low"), (40, "Medium"), (69.999, "Medium"), (70, "High"), (89.999, "High"), (90, "Critical")],
)
def test_risk_level(spark, score, level):
    assert spark.range(1).select(risk.risk_level(F.lit(score))).first()[0] == level
