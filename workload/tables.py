"""Mail-shaped views over the given tables.

The tables hold no mail, so headers, labels and link lists are derived from
``documents`` and ``labels`` with fixed CASE rules that reach every branch of
the operators. Every given text is used as it is; two mails per source, one with
an empty and one without a body, are added to them. Copies of a text get the same derived fields, so exact, repeated
and conflicting mails occur. The same SQL text runs in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailrisk.plans.standardization import write_mails, write_standardized

RAW_MAILS = """
SELECT d.doc_id AS row_key, d.source AS source_file,
  CAST(substr(d.source, 4) AS INT) AS src_no,
  CASE d.n_chars % 7
    WHEN 0 THEN concat('user', CAST(d.n_chars AS STRING), '@example.com')
    WHEN 1 THEN concat('Bob <bob.', CAST(d.n_chars AS STRING), '@mail.example.org>')
    WHEN 2 THEN 'no address' WHEN 3 THEN ' N/A ' WHEN 4 THEN NULL
    WHEN 5 THEN '  Alice@corp.example ' ELSE 'root@localhost' END AS sender,
  CASE d.n_chars % 4
    WHEN 0 THEN 'list@example.net' WHEN 1 THEN 'None' WHEN 2 THEN NULL
    ELSE concat('team', CAST(d.n_chars % 10 AS STRING), '@example.net') END AS receiver,
  CASE d.n_chars % 3
    WHEN 0 THEN concat('2024-01-0', CAST(d.n_chars % 9 + 1 AS STRING)) WHEN 1 THEN 'nan'
    ELSE 'Mon, 1 Jan 2024 10:00:00 +0000' END AS date,
  CASE
    WHEN d.n_chars % 9 = 0 THEN 'NULL'
    WHEN d.n_chars % 9 = 1 THEN '  URGENT!! ' || split_part(d.text, chr(10), 1)
    WHEN d.n_chars % 9 = 2 THEN NULL
    ELSE split_part(d.text, chr(10), 1) END AS subject,
  d.text AS body,
  CASE d.n_chars % 10
    WHEN 0 THEN concat('[', chr(39), 'http://a.example/x', chr(39), ',', chr(39), 'http://b.example/y', chr(39), ']')
    WHEN 1 THEN 'http://a.example/x,http://b.example/y'
    WHEN 2 THEN concat('a.com, b.com; ', chr(39), 'none', chr(39), '|')
    WHEN 3 THEN concat(chr(123), chr(39), 'a', chr(39), ', ', chr(39), 'b', chr(39), chr(125))
    WHEN 4 THEN 'x | y' WHEN 5 THEN '0' WHEN 6 THEN '[]' WHEN 7 THEN 'N/A' WHEN 8 THEN NULL
    ELSE concat('https://10.0.0.', CAST(d.n_chars % 250 AS STRING), '/login') END AS urls,
  CASE
    WHEN l.quality = 1 THEN CASE d.n_chars % 8
      WHEN 0 THEN 'legitimate' WHEN 1 THEN 'Legit' WHEN 2 THEN ' HAM ' WHEN 3 THEN 'benign.'
      WHEN 4 THEN 'safe' WHEN 5 THEN 'False' WHEN 6 THEN '(no)' ELSE '0.0' END
    WHEN l.quality = 0 THEN CASE d.n_chars % 8
      WHEN 0 THEN 'phishing' WHEN 1 THEN 'Phish' WHEN 2 THEN ' SPAM ' WHEN 3 THEN 'malicious'
      WHEN 4 THEN 'bad!' WHEN 5 THEN 'True' WHEN 6 THEN '_yes_' ELSE '1.0' END
    WHEN d.doc_id % 13 = 0 THEN NULL
    WHEN d.doc_id % 13 = 1 THEN 'n/a'
    WHEN d.doc_id % 13 = 2 THEN 'un-known'
    WHEN d.doc_id % 13 = 3 THEN '-1'
    WHEN d.lang = 'en' THEN '0'
    ELSE '1' END AS raw_label
FROM (
  SELECT doc_id, text, source, n_chars, lang FROM documents
  UNION ALL SELECT -1 - 2 * min(doc_id), '', source, min(n_chars), min(lang) FROM documents GROUP BY source
  UNION ALL SELECT -2 - 2 * max(doc_id), CAST(NULL AS STRING), source, max(n_chars), max(lang) FROM documents GROUP BY source
) d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

# Raw mails before labels are read; those without a body come once more, without a
# source and with a text.
LABELLED_RAW = """
SELECT row_key, source_file, ' ' || body AS text_combined, raw_label FROM raw_mails
UNION ALL SELECT row_key - 4000000000000000000, CASE WHEN body = '' THEN '' END, ' unsourced ' || source_file, raw_label
FROM raw_mails WHERE body IS NULL OR body = ''
"""

# Raw CSV records of several kinds of files, every text whole; all but the first kind
# are folded to what their encoding holds. Each kind has further rows: a short one,
# one with too many fields, an empty one.
VARIANTS = {
    "bom": ("\ufeffid,subject,message,label", "UTF-8"),
    "windows": ("id,Subject,Message,Class", "windows-1252"),
    "latin": ('id,"Email\nSubject",Body,is-phishing', "ISO-8859-1"),
    "clash": ("id,Subject,subject ,body,Label,label", "UTF-8"),
}


def csv_texts(fold: str) -> str:
    """SQL for ``variant, doc_id, label, subject, body``; ``fold`` replaces all but ASCII
    characters of ``{}`` by an e acute, in the words of the engine."""
    return f"""
SELECT variant, doc_id, label,
  CASE variant WHEN 'windows' THEN {fold.format("subject")} WHEN 'latin' THEN {fold.format("subject")} || ' ' || chr(129)
    ELSE subject END AS subject,
  CASE WHEN variant IN ('windows', 'latin') THEN {fold.format("body")} ELSE body END AS body
FROM (
  SELECT doc_id, split_part(text, chr(10), 1) AS subject, text AS body,
    CASE WHEN n_chars % 2 = 0 THEN 'spam' ELSE 'ham' END AS label,
    CASE WHEN src % 4 = 0 THEN 'bom' WHEN src % 4 = 1 THEN 'windows' WHEN src % 4 = 2 THEN 'latin' ELSE 'clash' END AS variant
  FROM (SELECT *, CAST(substr(source, 4) AS INT) AS src FROM documents))
"""


# Mails pasted as one text: header lines in several shapes before a conversation turn.
PASTED_MAILS = """
SELECT conv_id, turn,
  concat(
    CASE turn % 5
      WHEN 0 THEN concat('Subject: turn ', CAST(turn AS STRING), ' of ', CAST(conv_id AS STRING), chr(10))
      WHEN 1 THEN concat('  From: ', role, '@example.com  ', chr(10), 'SUBJECT:', chr(10), 'subject: again', chr(10))
      WHEN 2 THEN concat('hello', chr(13), chr(10), 'from: first', chr(10), 'From: second', chr(10))
      WHEN 3 THEN ''
      ELSE concat('see https://10.1.2.3/', role, ' now', chr(10)) END,
    text) AS mail
FROM conversations
"""


#: Session setting: spread the rows of a table before use. A file with a single row
#: group is read by one task; whoever has such files and many cores asks for it.
SPREAD = "spark.mailrisk.spread"
SPREAD_KEYS = {
    "documents": ("doc_id",),
    "pages": ("page_id",),
    "conversations": ("conv_id", "turn"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in SPREAD_KEYS and spark.conf.get(SPREAD, "false") == "true":
        rows = rows.repartition(spark.sparkContext.defaultParallelism, *SPREAD_KEYS[name])
    return rows


def _sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    return spark.sql(
        _with_placeholders(text, names), **{name: table(spark, sf_dir, name) for name in names}
    )


def _with_placeholders(text: str, names: tuple[str, ...]) -> str:
    for name in names:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(
            f"JOIN {name}", f"JOIN {{{name}}}"
        )
    return text


def raw_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as unstandardized mails with free-form labels."""
    return _sql(spark, sf_dir, RAW_MAILS, "documents", "labels")


def labelled_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw mails as a standardized-looking table whose label is still text."""
    text = _with_placeholders(LABELLED_RAW, ("raw_mails",))
    return spark.sql(text, raw_mails=raw_mails(spark, sf_dir)).withColumnRenamed("raw_label", "label")


def csv_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``variant, record``: raw CSV records of every document, and odd rows of each kind."""
    texts = _sql(spark, sf_dir, csv_texts("regexp_replace({}, '[^\\\\x00-\\\\x7F]', chr(233))"), "documents")

    def quoted(name: str):
        return F.concat(F.lit('"'), F.replace(F.col(name), F.lit('"'), F.lit('""')), F.lit('"'))

    fields = [F.concat(F.lit("id "), F.col("doc_id").cast("string"))]
    twice = F.when(F.col("variant") == "clash", F.concat(F.lit("first "), F.col("doc_id").cast("string"), F.lit(",")))
    records = texts.select("variant", F.concat(
        *fields, F.lit(","), F.coalesce(twice, F.lit("")), quoted("subject"), F.lit(","), quoted("body"), F.lit(","), F.col("label"),
        F.when(F.col("variant") == "clash", F.lit(",9")).otherwise(F.lit("")),
    ).alias("record"))
    odd = texts.select("variant").distinct().select(
        "variant", F.explode(F.array(F.lit("short"), F.lit("too,many,1,2,3,4,fields"), F.lit(""))).alias("record")
    )
    return records.unionByName(odd)


def pasted_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pasted_mails_from(table(spark, sf_dir, "conversations"))


def pasted_mails_from(conversations: DataFrame) -> DataFrame:
    """Pasted mails of a conversation table or stream."""
    return conversations.sparkSession.sql(
        _with_placeholders(PASTED_MAILS, ("conversations",)), conversations=conversations
    )


def feeds(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw mails as three feeds whose headers differ."""
    raw = raw_mails(spark, sf_dir)
    engine = [F.col("row_key").alias("_row_key"), F.col("source_file").alias("_source_file")]
    full = raw.where("src_no <= 6").select(
        *engine, "sender", "receiver", "date", "subject", "body",
        F.col("raw_label").alias("label"), "urls",
    )
    renamed = raw.where("src_no between 7 and 13").select(
        *engine,
        F.col("sender").alias("From"), F.col("receiver").alias(" To "),
        F.col("date").alias("Sent-Date"), F.col("subject").alias("Email  Subject"),
        F.col("body").alias("Message"), F.col("raw_label").alias("Class"),
        F.lit("spam").alias("Label"), F.col("urls").alias("Links"),
        F.lit("ignored").alias("links"),
    )
    ready = raw.where("src_no >= 14").select(
        *engine,
        F.concat(
            F.coalesce("subject", F.lit("")), F.lit("\n"), F.coalesce("body", F.lit(""))
        ).alias("Text"),
        F.col("raw_label").alias("is-phishing"),
    )
    return [full, renamed, ready]


_STAGES: dict[tuple[str, str, str], DataFrame] = {}


def _staged(name: str, build, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build a written table once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGES:
        _STAGES[key] = build(spark, sf_dir)
    return _STAGES[key]


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of the standardized feeds, before any filter (written once)."""
    return _staged("standardized", lambda s, d: write_standardized(s, feeds(s, d)), spark, sf_dir)


def mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical mail table: usable, conflict-free, one row per text (written once)."""
    return _staged(
        "mails", lambda s, d: write_mails(standardized(s, d)), spark, sf_dir
    )
