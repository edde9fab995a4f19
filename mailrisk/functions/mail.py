"""Split one pasted mail into subject, sender, body and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailrisk.functions.links import find_feature_urls
from mailrisk.functions.text import bind, strip

# Line boundaries and the two recognised header prefixes.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
SUBJECT_PREFIX = "subject:"
SENDER_PREFIX = "from:"


def _is_header(line: Column, prefix: str) -> Column:
    return F.lower(strip(line)).startswith(prefix)


def _header_value(line: Column, prefix: str) -> Column:
    return strip(F.substr(strip(line), F.lit(len(prefix) + 1)))


def _lifted_until(lines: Column, prefix: str) -> Column:
    """1-based position of the first such header with a value; 0 when none has."""
    return F.array_position(
        F.transform(
            lines,
            lambda line: _is_header(line, prefix) & (_header_value(line, prefix) != ""),
        ),
        True,
    )


def parse_mail(text: Column) -> Column:
    """Struct of ``subject, body, urls, sender, text_combined``.

    The first non-empty subject and sender lines are lifted out wherever they
    stand; empty header lines before them are dropped, later ones stay in the
    body. A text without any other line is its own body.
    """
    source = F.coalesce(text, F.lit(""))

    def from_lines(lines: Column) -> Column:
        subject_at = _lifted_until(lines, SUBJECT_PREFIX)
        sender_at = _lifted_until(lines, SENDER_PREFIX)
        marks = F.struct(
            F.when(subject_at > 0, subject_at).otherwise(F.size(lines)).alias("subject_end"),
            F.when(sender_at > 0, sender_at).otherwise(F.size(lines)).alias("sender_end"),
            subject_at.alias("subject_at"),
            sender_at.alias("sender_at"),
        )
        return bind(marks, lambda at: _pick(lines, at))

    def _pick(lines: Column, at: Column) -> Column:
        kept = F.filter(
            lines,
            lambda line, i: ~(
                (_is_header(line, SUBJECT_PREFIX) & (i < at["subject_end"]))
                | (_is_header(line, SENDER_PREFIX) & (i < at["sender_end"]))
            ),
        )
        return F.struct(
            _lifted(lines, at["subject_at"], SUBJECT_PREFIX).alias("subject"),
            _lifted(lines, at["sender_at"], SENDER_PREFIX).alias("sender"),
            strip(F.array_join(kept, "\n")).alias("rest"),
        )

    parsed = bind(F.split(source, LINE_BREAK), from_lines)
    links = F.array_join(find_feature_urls(source), " ")

    def assemble(part: Column) -> Column:
        body = F.when(part["rest"] != "", part["rest"]).otherwise(source)
        filled = F.filter(F.array(part["subject"], body, links), lambda field: field != "")
        return F.struct(
            part["subject"].alias("subject"),
            body.alias("body"),
            links.alias("urls"),
            part["sender"].alias("sender"),
            strip(F.array_join(filled, " ")).alias("text_combined"),
        )

    return bind(parsed, assemble)


def _lifted(lines: Column, position: Column, prefix: str) -> Column:
    line = F.get(lines, (position - 1).cast("int"))
    return F.when(position > 0, _header_value(line, prefix)).otherwise("")
