"""SQL building blocks of the checks, written for DuckDB.

They restate the rules independently of the Spark expressions. RE2 has ASCII
word boundaries only, so text is first folded to ASCII class by class (letters
and digits to ``_``, decimal digits to ``0``, blanks to a blank, the rest to
``#``); cleaning drops all of these anyway, so results on whole texts agree.
"""

from __future__ import annotations

from workload.tables import PASTED_MAILS, RAW_MAILS

# Whitespace characters and missing-value tokens.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
MISSING = "('', 'nan', 'none', 'null', 'na', 'n/a', '<na>')"
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip(x: str) -> str:
    return f"trim({x}, '{BLANKS}')"


def swap(x: str, pattern: str, by: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', '{flags}')"


def matches(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def clean(x: str) -> str:
    text = strip(f"coalesce({x}, '')")
    return f"CASE WHEN lower({text}) IN {MISSING} THEN '' ELSE {text} END"


def blank(x: str) -> str:
    return f"CASE WHEN lower({strip(f'coalesce({x}, {chr(39) * 2})')}) IN {MISSING} THEN '' ELSE {x} END"


def fold(x: str) -> str:
    x = swap(x, r"[^\x00-\x7F\P{Nd}]", "0")
    x = swap(x, r"[^\x00-\x7F\P{L}]|[^\x00-\x7F\P{N}]", "_")
    x = swap(x, rf"[{SPACE}]", " ")
    return swap(x, r"[^\x00-\x7F]", "#")


def clean_text(x: str) -> str:
    x = fold(f"lower({x})")
    x = swap(x, "<[^>]+>", " ")
    x = swap(x, r"https?://[^ ]+|www\.[^ ]+", " url ")
    x = swap(x, r"\b[\w.%+-]+@[\w.-]+\.[a-zA-Z]{2,}\b", " email ")
    x = swap(x, r"\b\d+(?:\.\d+)?\b", " num ")
    return f"trim({swap(x, '[^a-z]+', ' ')}, ' ')"


def decode_page_entities(x: str) -> str:
    """The references that occur in the pages; the ampersand comes last."""
    for name, by in (("copy", "\xa9"), ("middot", "\xb7"), ("quot", '"')):
        x = f"replace({x}, '&{name};', '{by}')"
    return swap(x, "&amp;?", "&")


LINK = r"(?i)(?:https?://|www\.)[^ <>''\")]+"


def n_links(folded: str) -> str:
    return matches(folded, LINK)


def listed_links(x: str) -> str:
    text = fold(strip(f"coalesce({x}, '')"))
    items = rf"regexp_split_to_array(trim({text}, '[](){{}}'), '[,;|][{SPACE}]*')"
    cleaned = f"""trim({strip('item')}, '"''')"""
    named = f"len([1 for item in {items} if lower({cleaned}) NOT IN {MISSING}])"
    return (
        f"CASE WHEN lower({text}) IN {MISSING} THEN 0 WHEN {n_links(text)} > 0 "
        f"THEN {n_links(text)} ELSE {named} END"
    )


def label(x: str) -> str:
    name = swap(f"lower({clean(x)})", r"\.0$", "", "")
    name = swap(name, rf"[^\p{{L}}\p{{N}}_{SPACE}]|_", " ")
    name = f"trim({swap(name, rf'[{SPACE}]+', ' ')}, ' ')"
    return (
        f"CASE WHEN {name} IN ('phishing','phish','spam','malicious','bad','true','yes','1') THEN 1 "
        f"WHEN {name} IN ('legitimate','legit','ham','benign','safe','false','no','0') THEN 0 END"
    )


def risk_level(score: str) -> str:
    return (
        f"CASE WHEN {score} < 40 THEN 'Low' WHEN {score} < 70 THEN 'Medium' "
        f"WHEN {score} < 90 THEN 'High' ELSE 'Critical' END"
    )


def with_parts(*names: str) -> str:
    """``WITH`` clause of the named parts and all parts they need, in order."""
    needed: list[str] = []

    def add(name: str) -> None:
        sql, uses = PARTS[name]
        for used in uses:
            add(used)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    # Materialized so that a part used twice is computed once.
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({PARTS[n][0]})" for n in needed) + "\n"


_COMPOSED = (
    f"trim({swap(f'''concat(subject, ' ', body, ' ', urls)''', rf'[{SPACE}]+', ' ')}, ' ')"
)
_FIELDS = ("sender", "receiver", "date", "subject", "body", "urls")

PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_mails": (RAW_MAILS, ()),
    "pasted_mails": (PASTED_MAILS, ()),
    "cleaned_fields": (
        "SELECT row_key, source_file, src_no, "
        + ", ".join(f"CASE WHEN src_no <= 13 THEN {clean(f)} ELSE '' END AS {f}" for f in _FIELDS)
        + f", {clean('''concat(coalesce(subject,''), chr(10), coalesce(body,''))''')} AS ready"
        + f", CAST({label('raw_label')} AS INTEGER) AS label FROM raw_mails",
        ("raw_mails",),
    ),
    "standardized": (
        f"SELECT row_key, source_file, {', '.join(_FIELDS)}, "
        f"CASE WHEN src_no <= 13 THEN {_COMPOSED} ELSE ready END AS text_combined, label "
        "FROM cleaned_fields",
        ("cleaned_fields",),
    ),
    "usable": (
        f"SELECT * REPLACE ({clean('text_combined')} AS text_combined) FROM standardized "
        f"WHERE label IS NOT NULL AND {clean('text_combined')} <> ''",
        ("standardized",),
    ),
    "distinct_rows": (
        "SELECT min(row_key) AS row_key, source_file, sender, receiver, date, subject, body, urls, "
        "text_combined, label FROM usable GROUP BY ALL",
        ("usable",),
    ),
    "mails": (
        "SELECT * FROM distinct_rows "
        "WHERE text_combined NOT IN (SELECT text_combined FROM distinct_rows "
        "GROUP BY text_combined HAVING count(DISTINCT label) > 1) "
        "QUALIFY row_number() OVER (PARTITION BY text_combined ORDER BY row_key) = 1",
        ("distinct_rows",),
    ),
    "cleaned": (
        f"SELECT row_key, source_file, label, text_combined, {clean_text('text_combined')} AS text_cleaned "
        "FROM mails",
        ("mails",),
    ),
    "hashed": (
        "SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat(CAST(row_key AS VARCHAR), ':42'))) AS pos "
        "FROM mails",
        ("mails",),
    ),
    "quota": (
        "SELECT label, floor(q) + CASE WHEN row_number() OVER (ORDER BY q - floor(q) DESC, label) "
        "<= w - sum(floor(q)) OVER () THEN 1 ELSE 0 END AS n_test "
        "FROM (SELECT label, w, w * n / total AS q FROM (SELECT label, CAST(n AS DOUBLE) AS n, total, "
        "ceil(CAST(0.2 AS DOUBLE) * total) AS w FROM (SELECT label, count(*) AS n, "
        "CAST(sum(count(*)) OVER () AS DOUBLE) AS total FROM mails GROUP BY label)))",
        ("mails",),
    ),
    "split": (
        "SELECT h.* EXCLUDE (pos), pos <= n_test AS is_test FROM hashed h JOIN quota USING (label)",
        ("hashed", "quota"),
    ),
    "words": (
        "SELECT s.row_key, s.label, s.is_test, "
        f"list_filter(string_split({clean_text('s.text_combined')}, ' '), lambda w: length(w) >= 2) AS ws "
        "FROM split s",
        ("split",),
    ),
    "grams": (
        "SELECT row_key, label, is_test, unnest(list_concat(ws, "
        "[ws[i] || ' ' || ws[i + 1] for i in range(1, greatest(len(ws), 1))])) AS term FROM words",
        ("words",),
    ),
    "counts": (
        "SELECT row_key, label, is_test, term, count(*) AS tf FROM grams GROUP BY ALL",
        ("grams",),
    ),
    "vocabulary": (
        "SELECT term, total_tf, df, ln((1 + n) / (1 + df)) + 1 AS idf, n, "
        "row_number() OVER (ORDER BY term) - 1 AS term_id FROM (SELECT * FROM ("
        "SELECT term, CAST(sum(tf) AS BIGINT) AS total_tf, count(*) AS df, "
        "(SELECT CAST(count(*) AS DOUBLE) FROM split WHERE NOT is_test) AS n "
        "FROM counts WHERE NOT is_test GROUP BY term) "
        "WHERE df >= 2 AND df <= CAST(0.95 AS DOUBLE) * n ORDER BY total_tf DESC, term LIMIT 30000)",
        ("counts", "split"),
    ),
    "raw_weights": (
        "SELECT row_key, label, is_test, term, term_id, (1 + ln(tf)) * idf AS w "
        "FROM counts JOIN vocabulary USING (term)",
        ("counts", "vocabulary"),
    ),
    "weights": (
        "SELECT row_key, label, is_test, term, term_id, "
        "w / sqrt(sum(w * w) OVER (PARTITION BY row_key)) AS weight FROM raw_weights",
        ("raw_weights",),
    ),
}


def feature_columns(source: str, parts: dict[str, str], keep: str) -> str:
    """The ten features of ``source``; ``parts`` maps mail parts to its columns."""
    base = (
        f"SELECT {keep}, {blank(parts['subject'])} AS s, {blank(parts['body'])} AS b0, "
        f"{blank(parts['urls'])} AS u, {blank(parts['sender'])} AS f, "
        f"{blank(parts['text_combined'])} AS c FROM {source}"
    )
    base = f"SELECT *, CASE WHEN b0 = '' THEN c ELSE b0 END AS b FROM ({base})"
    base = f"SELECT *, {strip('''concat(s, ' ', b)''')} AS t, {listed_links('u')} AS listed FROM ({base})"
    base = f"SELECT *, {fold('t')} AS a, {fold('f')} AS fa, {fold(strip('''concat(t, ' ', u)'''))} AS z FROM ({base})"
    tag = r"<[ \t-\r\x1c-\x1f]*/?[ \t-\r\x1c-\x1f]*[a-zA-Z][^>]*>"
    values = {
        "n_links": f"greatest({n_links('a')}, listed)",
        "has_ip_url": r"regexp_matches(z, '(\d{1,3}\.){3}\d{1,3}(:\d{2,5})?(/|$)')",
        "html_tag_count": matches("a", tag),
        "html_ratio": f"(length(a) - length({swap('a', tag, '')})) / CAST(greatest(length(a), 1) AS DOUBLE)",
        "body_len": "length(b)",
        "subject_len": "length(s)",
        "n_exclamation": "length(t) - length(replace(t, '!', ''))",
        "n_upper_words": matches("a", r"\b[A-Z]{2,}\b"),
        "sender_has_email": r"regexp_matches(fa, '\b[\w.%+-]+@[\w.-]+\.[a-zA-Z]{2,}\b')",
        "url_count_from_column": "listed",
    }
    names = [part.split(" AS ")[-1].strip() for part in keep.split(",")]
    features = ", ".join(f"CAST({sql} AS DOUBLE) AS {name}" for name, sql in values.items())
    return f"SELECT {', '.join(names)}, c AS text_combined, {features} FROM ({base})"


MAIL_PART_COLUMNS = {name: name for name in ("subject", "body", "urls", "sender", "text_combined")}
PARTS["features"] = (
    feature_columns("split", MAIL_PART_COLUMNS, "row_key, label, is_test, source_file"),
    ("split",),
)
