"""SQL checks: ``name -> DuckDB query`` with the column names of the Spark query."""

from __future__ import annotations

from workload import sql
from workload.sql import with_parts
from workload.tables import LABELLED_RAW, csv_texts

ORACLES: dict[str, str] = {}

_RAW_FIELDS = ("sender", "receiver", "date", "subject", "urls")
_FEATURES = (
    "n_links", "has_ip_url", "html_tag_count", "html_ratio", "body_len", "subject_len",
    "n_exclamation", "n_upper_words", "sender_has_email", "url_count_from_column",
)
_ROUNDED = ", ".join(f"round({f}, 6) AS {f}" if f == "html_ratio" else f for f in _FEATURES)
_MAIL = "row_key, source_file, sender, receiver, date, subject, body, urls, text_combined, label"

_NUMERIC = "TRY_CAST(trim(raw_label) AS DOUBLE)"

ORACLES["q_clean_value"] = with_parts("raw_mails") + (
    "SELECT row_key, " + ", ".join(f"{sql.clean(f)} AS {f}" for f in _RAW_FIELDS) + " FROM raw_mails"
)
ORACLES["q_normalize_label"] = with_parts("raw_mails") + (
    f"SELECT row_key, raw_label, CAST({sql.label('raw_label')} AS INTEGER) AS label FROM raw_mails"
)
ORACLES["q_standardize"] = with_parts("mails") + f"SELECT {_MAIL} FROM mails"
ORACLES["q_exact_dedup"] = with_parts("distinct_rows") + (
    "SELECT row_key, source_file, label FROM distinct_rows"
)
ORACLES["q_standardize_summary"] = with_parts("standardized", "usable", "distinct_rows", "mails") + """
, conflicts AS (SELECT text_combined FROM distinct_rows GROUP BY text_combined HAVING count(DISTINCT label) > 1)
, c AS (SELECT
  (SELECT count(*) FROM standardized) AS loaded, (SELECT count(*) FROM usable) AS n_usable,
  (SELECT count(*) FROM distinct_rows) AS n_distinct, (SELECT count(*) FROM mails) AS n_mails,
  (SELECT count(*) FROM conflicts) AS n_conflicts,
  (SELECT count(*) FROM distinct_rows WHERE text_combined IN (SELECT text_combined FROM conflicts)) AS n_conflict_rows)
SELECT 'rows_before_cleaning' AS metric, loaded AS value FROM c
UNION ALL SELECT 'rows_after_load', loaded FROM c
UNION ALL SELECT 'rows_after_cleaning', n_mails FROM c
UNION ALL SELECT 'duplicate_rows_removed', (n_usable - n_distinct) + (n_distinct - n_conflict_rows - n_mails) FROM c
UNION ALL SELECT 'conflicting_texts_removed', n_conflicts FROM c
UNION ALL SELECT 'conflicting_rows_removed', n_conflict_rows FROM c
UNION ALL SELECT 'label_0', (SELECT count(*) FROM mails WHERE label = 0)
UNION ALL SELECT 'label_1', (SELECT count(*) FROM mails WHERE label = 1)"""
ORACLES["q_load_eda"] = with_parts("raw_mails") + (
    f"SELECT row_key, source_file, coalesce(text_combined, '') AS text_combined, "
    f"CAST({_NUMERIC} AS INTEGER) AS label FROM ({LABELLED_RAW}) WHERE {_NUMERIC} IN (0, 1)"
)
ORACLES["q_load_training"] = with_parts("raw_mails") + (
    f"SELECT row_key, coalesce(source_file, 'unknown') AS source_file, "
    f"{sql.strip('text_combined')} AS text_combined, CAST({_NUMERIC} AS INTEGER) AS label "
    f"FROM ({LABELLED_RAW}) WHERE {_NUMERIC} IN (0, 1) AND {sql.strip('text_combined')} <> ''"
)

ORACLES["q_clean_text"] = f"SELECT doc_id, {sql.clean_text('text')} AS text_cleaned FROM documents"
ORACLES["q_clean_html"] = (
    f"SELECT page_id, {sql.clean_text(sql.decode_page_entities('html'))} AS text_cleaned FROM pages"
)
ORACLES["q_entity_decode"] = f"SELECT page_id, {sql.decode_page_entities('html')} AS html FROM pages"
ORACLES["q_count_urls"] = (
    "SELECT page_id, "
    f"CAST({sql.matches(sql.fold('html'), '(?i)(?:https?://[^ ]+|www[.][^ ]+)')} AS INTEGER) AS cleaning_urls, "
    f"CAST({sql.n_links(sql.fold('html'))} AS INTEGER) AS feature_urls FROM pages"
)
ORACLES["q_url_column"] = with_parts("raw_mails") + (
    f"SELECT row_key, urls, CAST({sql.listed_links('urls')} AS INTEGER) AS url_count FROM raw_mails"
)
_STANDARD_FEATURES = sql.feature_columns("standardized", sql.MAIL_PART_COLUMNS, "row_key")
ORACLES["q_metadata_features"] = with_parts("standardized") + (
    f"SELECT row_key, {_ROUNDED} FROM ({_STANDARD_FEATURES})"
)
_PAGE_PARTS = {
    "subject": "''", "body": "html", "urls": "url", "sender": "''",
    "text_combined": f"trim({sql.swap('''concat(' ', html, ' ', url)''', f'[{sql.SPACE}]+', ' ')}, ' ')",
}
ORACLES["q_html_features"] = (
    f"SELECT page_id, {_ROUNDED} FROM ({sql.feature_columns('pages', _PAGE_PARTS, 'page_id')})"
)
ORACLES["q_model_input"] = with_parts("features") + (
    f"SELECT row_key, text_combined, {_ROUNDED} FROM features"
)
# Header lines: the first with a value is lifted, empty ones up to it are dropped.
_HEADER = "lower({s}) LIKE '{p}:%'"


def _lifted(prefix: str, name: str) -> str:
    is_header = _HEADER.format(s="stripped", p=prefix)
    value = sql.strip(f"substr(stripped, {len(prefix) + 2})")
    return (
        f"{name}_at AS (SELECT conv_id, turn, min(i) AS at, first(v ORDER BY i) AS v FROM "
        f"(SELECT conv_id, turn, i, {value} AS v FROM lines WHERE {is_header}) "
        "WHERE v <> '' GROUP BY ALL)"
    )


_LINES = (
    "split_mail AS (SELECT conv_id, turn, mail, regexp_split_to_array(mail, "
    r"'\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]') AS ls FROM pasted_mails), "
    "lines AS (SELECT conv_id, turn, i, line, "
    f"{sql.strip('line')} AS stripped FROM (SELECT conv_id, turn, unnest(ls) AS line, "
    "unnest(range(1, len(ls) + 1)) AS i FROM split_mail))"
)
_FEATURE_LINK_RAW = rf"(?i)(?:https?://|www\.)[^{sql.SPACE}<>''\")]+"
sql.PARTS["parsed"] = (
    f"WITH {_LINES}, {_lifted('subject', 'subject')}, {_lifted('from', 'sender')}, "
    "rest AS (SELECT l.conv_id, l.turn, string_agg(line, chr(10) ORDER BY i) AS b FROM lines l "
    "LEFT JOIN subject_at s USING (conv_id, turn) LEFT JOIN sender_at f USING (conv_id, turn) "
    f"WHERE NOT ({_HEADER.format(s='stripped', p='subject')} AND i <= coalesce(s.at, 1000000000)) "
    f"AND NOT ({_HEADER.format(s='stripped', p='from')} AND i <= coalesce(f.at, 1000000000)) GROUP BY ALL), "
    "joined AS (SELECT m.conv_id, m.turn, m.mail, coalesce(s.v, '') AS subject, coalesce(f.v, '') AS sender, "
    f"CASE WHEN {sql.strip('''coalesce(r.b, '')''')} <> '' THEN {sql.strip('r.b')} ELSE m.mail END AS body, "
    f"array_to_string(regexp_extract_all(m.mail, '{_FEATURE_LINK_RAW}'), ' ') AS urls FROM split_mail m "
    "LEFT JOIN subject_at s USING (conv_id, turn) LEFT JOIN sender_at f USING (conv_id, turn) "
    "LEFT JOIN rest r USING (conv_id, turn)) "
    "SELECT conv_id, turn, mail, subject, body, urls, sender, "
    f"{sql.strip('''array_to_string(list_filter([subject, body, urls], lambda p: p <> ''), ' ')''')} AS text_combined "
    "FROM joined"    , ("pasted_mails",),
)
ORACLES["q_parse_email"] = with_parts("parsed") + "SELECT * EXCLUDE (mail) FROM parsed"

ORACLES["q_class_distribution"] = with_parts("usable") + (
    "SELECT CAST(l AS INTEGER) AS label, (SELECT count(*) FROM usable WHERE label = l) AS row_count "
    "FROM (VALUES (0), (1)) AS t(l)"
)
ORACLES["q_length_histogram"] = with_parts("usable") + """
, lengths AS (SELECT label, CAST(length(text_combined) AS DOUBLE) AS n FROM usable)
, clips AS (SELECT label, quantile_cont(n, 0.99) AS hi, min(n) AS lo FROM lengths GROUP BY label)
, bounds AS (SELECT label, hi AS clip, CASE WHEN hi > lo THEN lo ELSE lo - 0.5 END AS lo,
  CASE WHEN hi > lo THEN hi ELSE lo + 0.5 END AS hi FROM clips)
, binned AS (SELECT label, least(floor((least(n, clip) - lo) * 40 / (hi - lo)), 39) AS bin FROM lengths JOIN bounds USING (label))
SELECT b.label, CAST(g AS INTEGER) AS bin, round(lo + g * ((hi - lo) / 40), 6) AS bin_low,
  round(lo + (g + 1) * ((hi - lo) / 40), 6) AS bin_high,
  (SELECT count(*) FROM binned x WHERE x.label = b.label AND x.bin = g) AS row_count
FROM bounds b, range(40) AS t(g)"""
ORACLES["q_missing"] = with_parts("standardized") + "\nUNION ALL ".join(
    f"SELECT '{f}' AS \"column\", count(*) FILTER (WHERE {f} IS NULL OR CAST({f} AS VARCHAR) = '') AS missing_count, "
    f"round(count(*) FILTER (WHERE {f} IS NULL OR CAST({f} AS VARCHAR) = '') / count(*), 6) AS missing_rate FROM standardized"
    for f in _MAIL.split(", ")[1:]
)
ORACLES["q_sources"] = with_parts("raw_mails") + (
    "SELECT CASE WHEN coalesce(source_file, '') = '' THEN 'unknown' ELSE source_file END AS source_file, "
    f"count(*) AS row_count, round(count(*) / sum(count(*)) OVER (), 6) AS row_rate FROM ({LABELLED_RAW}) GROUP BY 1"
)


def _metrics(pairs: dict[str, str], source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS metric, CAST({value} AS BIGINT) AS value FROM {source}"
        for name, value in pairs.items()
    )


_USABLE_CLEANED = (
    f", c AS MATERIALIZED (SELECT row_key, label, text_combined AS raw, {sql.clean_text('text_combined')} AS cln FROM usable)"
)
ORACLES["q_duplicate_stats"] = with_parts("usable") + _USABLE_CLEANED + """
, r AS (SELECT raw, count(*) AS n FROM c GROUP BY raw), k AS (SELECT cln, count(*) AS n FROM c GROUP BY cln)
""" + _metrics(
    {
        "rows": "(SELECT count(*) FROM c)",
        "duplicate_rows_text_combined": "(SELECT sum(n - 1) FROM r)",
        "duplicate_groups_text_combined": "(SELECT count(*) FROM r WHERE n > 1)",
        "duplicate_rows_text_cleaned": "(SELECT sum(n - 1) FROM k)",
        "duplicate_groups_text_cleaned": "(SELECT count(*) FROM k WHERE n > 1)",
        "rows_after_drop_duplicate_text_cleaned": "(SELECT count(*) FROM k)",
    },
    "(SELECT 1)",
)
ORACLES["q_cleaned_duplicates"] = with_parts("usable") + _USABLE_CLEANED + """
, w AS (SELECT * FROM c WHERE cln <> '')
, bad AS (SELECT cln FROM w GROUP BY cln HAVING count(DISTINCT label) > 1)
""" + _metrics(
    {
        "rows_before_cleaned_dedup": "(SELECT count(*) FROM w)",
        "duplicate_rows_text_combined": "(SELECT count(*) - count(DISTINCT raw) FROM w)",
        "duplicate_rows_text_cleaned": "(SELECT count(*) - count(DISTINCT cln) FROM w)",
        "conflicting_cleaned_texts": "(SELECT count(*) FROM bad)",
        "rows_removed_conflicting_cleaned_labels": "(SELECT count(*) FROM w WHERE cln IN (SELECT cln FROM bad))",
        "rows_after_drop_duplicate_text_cleaned": "(SELECT count(DISTINCT cln) FROM w WHERE cln NOT IN (SELECT cln FROM bad))",
    },
    "(SELECT 1)",
)
ORACLES["q_cleaned_dedup"] = with_parts("usable") + _USABLE_CLEANED + """
, w AS (SELECT * FROM c WHERE cln <> '')
SELECT row_key, label, cln AS text_cleaned FROM w
WHERE cln NOT IN (SELECT cln FROM w GROUP BY cln HAVING count(DISTINCT label) > 1)
QUALIFY row_number() OVER (PARTITION BY cln ORDER BY row_key) = 1"""
ORACLES["q_top_terms"] = with_parts("counts") + """
SELECT label, CASE WHEN label = 1 THEN 'phishing' ELSE 'legitimate' END AS class_name, term,
  CAST(sum(tf) AS BIGINT) AS count FROM counts GROUP BY label, term HAVING count(*) >= 2
QUALIFY row_number() OVER (PARTITION BY label ORDER BY sum(tf) DESC, term) <= 30"""

ORACLES["q_split"] = with_parts("split") + "SELECT row_key, label, is_test FROM split"
ORACLES["q_class_weight"] = with_parts("mails") + (
    "SELECT row_key, label, round(count(*) OVER () / (2 * count(*) OVER (PARTITION BY label)), 6) AS class_weight FROM mails"
)
ORACLES["q_ngrams"] = with_parts("counts") + "SELECT row_key, term, tf FROM counts"
ORACLES["q_vocabulary"] = with_parts("vocabulary") + (
    "SELECT CAST(term_id AS INTEGER) AS term_id, term, total_tf, df, round(idf, 6) AS idf FROM vocabulary"
)
ORACLES["q_tfidf"] = with_parts("weights") + (
    "SELECT row_key, CAST(term_id AS INTEGER) AS term_id, round(weight, 6) AS weight FROM weights"
)

# Scores derived from features, one row per mail and model.
_SCORED = (
    "scored AS MATERIALIZED (SELECT row_key, label, text_combined, model, score, "
    "CAST(score >= 0.5 AS INTEGER) AS predicted_label FROM ("
    "SELECT row_key, label, text_combined, 'by_links' AS model, n_links / (n_links + 1) AS score FROM features "
    "UNION ALL SELECT row_key, label, text_combined, 'by_length', body_len / (body_len + 1500) FROM features "
    "UNION ALL SELECT row_key, label, text_combined, 'by_subject', (subject_len % 100) / 100 FROM features))"
)
_CELLS = (
    "count(*) FILTER (WHERE label = 0 AND predicted_label = 0) AS true_negative, "
    "count(*) FILTER (WHERE label = 0 AND predicted_label = 1) AS false_positive, "
    "count(*) FILTER (WHERE label = 1 AND predicted_label = 0) AS false_negative, "
    "count(*) FILTER (WHERE label = 1 AND predicted_label = 1) AS true_positive"
)
_CURVE = (
    "totals AS (SELECT model, sum(label) AS p, count(*) - sum(label) AS n FROM scored GROUP BY model), "
    "steps AS (SELECT model, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY model, score), "
    "curve AS (SELECT s.*, t.p, t.n, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp "
    "FROM steps s JOIN totals t USING (model) WINDOW w AS (PARTITION BY model ORDER BY score DESC))"
)
_WITH_SCORES = with_parts("features") + ", " + _SCORED + ", " + _CURVE
_RATES = (
    "(tn + tp) / (tn + fp + fn + tp) AS accuracy, "
    "CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS \"precision\", "
    "CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall, "
    "CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1"
)
_RATED = (
    f"(SELECT *, {_RATES} FROM (SELECT model, true_negative AS tn, false_positive AS fp, "
    f"false_negative AS fn, true_positive AS tp FROM (SELECT model, {_CELLS} FROM scored GROUP BY model)))"
)
ORACLES["q_metrics"] = _WITH_SCORES + f"""
, ranks AS (SELECT model, sum(pos * (n - fp + neg / 2)) / any_value(p) / any_value(n) AS roc_auc,
  sum(pos * (tp / (tp + fp))) / any_value(p) AS pr_auc FROM curve GROUP BY model)
SELECT model, round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision", round(recall, 6) AS recall,
  round(f1, 6) AS f1, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, tn AS true_negative,
  fp AS false_positive, fn AS false_negative, tp AS true_positive FROM {_RATED} JOIN ranks USING (model)"""
ORACLES["q_confusion"] = _WITH_SCORES + f"SELECT model, {_CELLS} FROM scored GROUP BY model"
ORACLES["q_roc"] = _WITH_SCORES + """
SELECT model, round(score, 9) AS threshold, round(fp / n, 9) AS fpr, round(tp / p, 9) AS tpr FROM curve
UNION ALL SELECT model, NULL, 0, 0 FROM totals"""
ORACLES["q_pr"] = _WITH_SCORES + """
SELECT model, round(score, 9) AS threshold, round(tp / (tp + fp), 9) AS "precision", round(tp / p, 9) AS recall,
  round(p / (p + n), 9) AS baseline FROM curve
UNION ALL SELECT model, NULL, 1, 0, round(p / (p + n), 9) FROM totals"""
ORACLES["q_best_model"] = _WITH_SCORES + (
    f"SELECT model, round(f1, 6) AS f1 FROM {_RATED} ORDER BY f1 DESC, model LIMIT 1"
)
ORACLES["q_errors"] = _WITH_SCORES + """
SELECT row_key, text_combined, label AS true_label, predicted_label, round(score, 6) AS phishing_probability,
  CASE WHEN label = 0 THEN 'false_positive' ELSE 'false_negative' END AS error_type
FROM scored WHERE model = 'by_links' AND label <> predicted_label
QUALIFY row_number() OVER (PARTITION BY label ORDER BY row_key) <= 10"""
ORACLES["q_sample_predictions"] = _WITH_SCORES + f"""
SELECT row_key, text_combined, label AS true_label, predicted_label, round(score, 6) AS phishing_probability,
  round(score * 100, 6) AS risk_score, {sql.risk_level('score * 100')} AS risk_level
FROM scored WHERE model = 'by_links' ORDER BY row_key LIMIT 20"""

_EXPERIMENTS = (
    ("src1_src2_to_src3", ("src1", "src2"), ("src3",)),
    ("src4_to_src5", ("src4",), ("src5",)),
    ("absent_to_src5", ("absent",), ("src5",)),
)


def _mask(keywords: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower(source_file), '{k}')" for k in keywords) + ")"


ORACLES["q_source_mask"] = with_parts("mails") + (
    "SELECT row_key, source_file, "
    + ", ".join(f"{_mask(train)} AS in_{name}" for name, train, _ in _EXPERIMENTS)
    + " FROM mails"
)
ORACLES["q_holdout_counts"] = with_parts("mails") + (
    "SELECT experiment, CASE WHEN e OR f THEN 'skipped' ELSE 'ok' END AS status, "
    "CASE WHEN e THEN 'empty train or test split' WHEN f THEN "
    "'training split does not contain at least two examples per class' ELSE '' END AS note, "
    "a0 + a1 AS train_rows, b0 + b1 AS test_rows, a0 AS train_legitimate, a1 AS train_phishing, "
    "b0 AS test_legitimate, b1 AS test_phishing FROM (SELECT *, a0 + a1 = 0 OR b0 + b1 = 0 AS e, "
    "least(a0, a1) < 2 AS f FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS experiment, "
        + ", ".join(
            f"count(*) FILTER (WHERE {_mask(side)} AND label = {label}) AS {letter}{label}"
            for letter, side in (("a", train), ("b", test)) for label in (0, 1)
        )
        + " FROM mails"
        for name, train, test in _EXPERIMENTS
    )
    + "))"
)

sql.PARTS["moments"] = (
    "SELECT " + ", ".join(
        f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS s_{f}"
        for f in _FEATURES
    ) + " FROM features WHERE NOT is_test",
    ("features",),
)
sql.PARTS["scaled"] = (
    "SELECT row_key, label, is_test, text_combined, "
    + ", ".join(f"{f} AS raw_{f}, ({f} - m_{f}) / s_{f} AS {f}" for f in _FEATURES)
    + " FROM features, moments",
    ("features", "moments"),
)
ORACLES["q_scaled_metadata"] = with_parts("scaled") + (
    "SELECT row_key, " + ", ".join(f"round({f}, 6) AS {f}" for f in _FEATURES) + " FROM scaled"
)
# Model input blanks missing tokens; mail texts are never such a token, so the
# weights of the split mails are those of the model input.
sql.PARTS["odds"] = (
    "SELECT term_id, term, ln((coalesce(w1, 0) + 1) / (sum(coalesce(w1, 0)) OVER () + count(*) OVER ())) "
    "- ln((coalesce(w0, 0) + 1) / (sum(coalesce(w0, 0)) OVER () + count(*) OVER ())) AS coefficient "
    "FROM vocabulary LEFT JOIN (SELECT term_id, sum(weight) FILTER (WHERE label = 1) AS w1, "
    "sum(weight) FILTER (WHERE label = 0) AS w0 FROM weights WHERE NOT is_test GROUP BY term_id) USING (term_id)",
    ("vocabulary", "weights"),
)
sql.PARTS["text_score"] = (
    "SELECT s.row_key, s.label, s.is_test, s.text_combined, "
    "coalesce(t.total, 0) + (SELECT ln(sum(label)) - ln(count(*) - sum(label)) FROM split WHERE NOT is_test) AS decision "
    "FROM split s LEFT JOIN (SELECT row_key, sum(weight * coefficient) AS total FROM weights "
    "JOIN odds USING (term_id) GROUP BY row_key) t USING (row_key)",
    ("split", "weights", "odds"),
)
ORACLES["q_naive_bayes"] = with_parts("text_score") + (
    "SELECT row_key, label, CAST(decision > 0 AS INTEGER) AS predicted_label, "
    "round(1 / (1 + exp(-decision)), 6) AS score FROM text_score WHERE is_test"
)
ORACLES["q_naive_bayes_coefficients"] = with_parts("odds") + (
    "SELECT term AS feature, round(coefficient, 6) AS coefficient FROM odds"
)
sql.PARTS["similarities"] = (
    "SELECT s.row_key, coalesce(m.best, 0) AS max_similarity FROM split s LEFT JOIN ("
    "SELECT row_key, max(dot) AS best FROM (SELECT a.row_key, b.row_key AS other, sum(a.weight * b.weight) AS dot "
    "FROM weights a JOIN weights b ON a.term_id = b.term_id WHERE a.is_test AND NOT b.is_test "
    "GROUP BY a.row_key, b.row_key) GROUP BY row_key) m USING (row_key) WHERE s.is_test",
    ("split", "weights"),
)
ORACLES["q_max_similarity"] = with_parts("similarities") + (
    "SELECT row_key, round(max_similarity, 6) AS max_similarity FROM similarities"
)
ORACLES["q_near_duplicates"] = with_parts("similarities") + """
SELECT (SELECT count(*) FROM split WHERE NOT is_test) AS train_rows, count(*) AS test_rows,
  round(avg(max_similarity), 6) AS mean_max_similarity,
  round(quantile_cont(max_similarity, 0.5), 6) AS median_max_similarity,
  round(quantile_cont(max_similarity, 0.9), 6) AS p90_max_similarity,
  round(quantile_cont(max_similarity, 0.95), 6) AS p95_max_similarity,
  count(*) FILTER (WHERE max_similarity > 0.9) AS count_similarity_gt_0_90,
  round(count(*) FILTER (WHERE max_similarity > 0.9) / count(*), 6) AS ratio_similarity_gt_0_90,
  count(*) FILTER (WHERE max_similarity > 0.95) AS count_similarity_gt_0_95,
  round(count(*) FILTER (WHERE max_similarity > 0.95) / count(*), 6) AS ratio_similarity_gt_0_95
FROM similarities"""

# Metadata coefficient: difference of the class means of the scaled feature.
sql.PARTS["metadata_weights"] = (
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{f}' AS feature, avg({f}) FILTER (WHERE label = 1) "
        f"- avg({f}) FILTER (WHERE label = 0) AS coefficient FROM scaled WHERE NOT is_test"
        for i, f in enumerate(_FEATURES)
    ),
    ("scaled",),
)
sql.PARTS["metadata_rows"] = (
    "SELECT row_key, label, is_test, position, feature, raw_value, scaled_value, coefficient, "
    "scaled_value * coefficient AS contribution FROM ("
    + " UNION ALL ".join(
        f"SELECT row_key, label, is_test, '{f}' AS feature, raw_{f} AS raw_value, {f} AS scaled_value FROM scaled"
        for f in _FEATURES
    )
    + ") JOIN metadata_weights USING (feature)",
    ("scaled", "metadata_weights"),
)
sql.PARTS["full_score"] = (
    "SELECT row_key, t.label, t.is_test, text_combined, 1 / (1 + exp(-(decision + extra))) AS p FROM text_score t "
    "JOIN (SELECT row_key, sum(contribution) AS extra FROM metadata_rows GROUP BY row_key) USING (row_key)",
    ("text_score", "metadata_rows"),
)
ORACLES["q_score"] = with_parts("full_score") + (
    "SELECT row_key, CAST(p >= 0.7 AS INTEGER) AS predicted_label, "
    "CASE WHEN p >= 0.7 THEN 'phishing' ELSE 'legitimate' END AS prediction, "
    "round(p, 6) AS phishing_probability, round(p * 100, 6) AS risk_score, "
    f"{sql.risk_level('p * 100')} AS risk_level FROM full_score WHERE is_test"
)
ORACLES["q_global_indicators"] = with_parts("odds") + """
(SELECT 'phishing' AS class_name, term, round(coefficient, 6) AS coefficient FROM odds ORDER BY odds.coefficient DESC, term LIMIT 20)
UNION ALL
(SELECT 'legitimate', term, round(coefficient, 6) FROM odds ORDER BY odds.coefficient, term LIMIT 20)"""
ORACLES["q_metadata_coefficients"] = with_parts("metadata_weights") + (
    "SELECT feature, round(coefficient, 6) AS coefficient FROM metadata_weights"
)
sql.PARTS["text_rows"] = (
    "SELECT row_key, label, term, weight, coefficient, weight * coefficient AS contribution, "
    "row_number() OVER (PARTITION BY row_key ORDER BY weight * coefficient DESC, term) AS rank "
    "FROM (SELECT row_key, label, is_test, term_id, weight FROM weights) JOIN odds USING (term_id) "
    "WHERE is_test AND weight * coefficient > 0",
    ("weights", "odds"),
)
ORACLES["q_explain_text"] = with_parts("text_rows") + (
    "SELECT row_key, CAST(rank AS INTEGER) AS rank, term, round(weight, 6) AS tfidf_value, "
    "round(coefficient, 6) AS coefficient, round(contribution, 6) AS contribution FROM text_rows WHERE rank <= 10"
)
ORACLES["q_explain_metadata"] = with_parts("metadata_rows") + (
    "SELECT row_key, feature, round(raw_value, 6) AS raw_value, round(scaled_value, 6) AS scaled_value, "
    "round(coefficient, 6) AS coefficient, round(contribution, 6) AS contribution, "
    "CASE WHEN contribution > 0 THEN 'toward_phishing' ELSE 'toward_legitimate' END AS direction "
    "FROM metadata_rows WHERE is_test"
)
ORACLES["q_soc_report"] = with_parts("full_score", "text_rows", "metadata_rows") + """
, chosen AS (SELECT row_key, label, text_combined, p FROM full_score WHERE is_test ORDER BY p DESC, row_key LIMIT 1)
, t AS (SELECT string_agg(term, '|' ORDER BY rank) AS l, string_agg(term, ', ' ORDER BY rank) FILTER (WHERE rank <= 3) AS s
  FROM text_rows WHERE rank <= 10 AND row_key IN (SELECT row_key FROM chosen))
, o AS (SELECT feature, row_number() OVER (ORDER BY abs(contribution) DESC, position) AS rank FROM metadata_rows
  WHERE row_key IN (SELECT row_key FROM chosen))
, m AS (SELECT string_agg(feature, '|' ORDER BY rank) AS l, string_agg(feature, ', ' ORDER BY rank) FILTER (WHERE rank <= 3) AS s FROM o)
SELECT substr(text_combined, 1, 700) AS original_email_preview, label AS true_label,
  CAST(p > 0.5 AS INTEGER) AS predicted_label, CASE WHEN p > 0.5 THEN 'phishing' ELSE 'legitimate' END AS predicted_class,
  round(p, 6) AS phishing_probability, round(p * 100, 6) AS risk_score, """ + sql.risk_level("p * 100") + """ AS risk_level,
  format('The model assigns {:.3f} phishing probability. Top text drivers include {}; top metadata drivers include {}. Review the message body, links, and sender context before action.',
    p, coalesce(t.s, 'no active text terms'), coalesce(m.s, 'no metadata signals')) AS soc_explanation,
  coalesce(t.l, '') AS top_text_terms, coalesce(m.l, '') AS top_metadata_features
FROM chosen, t, m"""

ORACLES["q_soc_entries"] = with_parts("full_score", "text_rows", "metadata_rows") + """
, chosen AS (SELECT row_key, label FROM full_score WHERE is_test ORDER BY p DESC, row_key LIMIT 1)
SELECT chosen.label AS true_label, 'text' AS kind, CAST(rank AS INTEGER) AS rank, term AS name, round(weight, 6) AS value,
  round(coefficient, 6) AS coefficient, round(contribution, 6) AS contribution
FROM text_rows JOIN chosen USING (row_key) WHERE rank <= 10
UNION ALL SELECT label, 'metadata', CAST(row_number() OVER (ORDER BY abs(c) DESC, position) AS INTEGER), feature,
  round(scaled_value, 6), round(coefficient, 6), round(c, 6)
FROM (SELECT chosen.label, feature, position, scaled_value, coefficient, contribution AS c FROM metadata_rows JOIN chosen USING (row_key))"""

ORACLES["q_linear_certificates"] = with_parts("split", "vocabulary") + """
SELECT model, (SELECT count(*) FROM split WHERE NOT is_test) AS train_rows, (SELECT count(*) FROM vocabulary) AS vocabulary,
  CAST(0 AS DOUBLE) AS relative_gap, true AS bounded
FROM (VALUES ('logistic_regression'), ('linear_svm'), ('logistic_regression_text_metadata')) models(model)"""

ORACLES["q_svd_certificate"] = with_parts("split", "weights") + """
SELECT (SELECT count(*) FROM split WHERE NOT is_test) AS train_rows,
  CAST(least(100, (SELECT count(*) FROM vocabulary)) AS BIGINT) AS components,
  round((SELECT sum(weight * weight) FROM weights WHERE NOT is_test), 6) AS energy,
  true AS residuals_within, true AS orthogonal, true AS energy_kept"""

# Pasted mails scored with the closed-form model.
sql.PARTS["pasted_features"] = (
    sql.feature_columns("parsed", sql.MAIL_PART_COLUMNS, "conv_id, turn, mail"), ("parsed",),
)
sql.PARTS["pasted_words"] = (
    f"SELECT conv_id, turn, list_filter(string_split({sql.clean_text('text_combined')}, ' '), "
    "lambda w: length(w) >= 2) AS ws FROM pasted_features",
    ("pasted_features",),
)
sql.PARTS["pasted_weights"] = (
    "SELECT conv_id, turn, term, (1 + ln(tf)) * idf AS w FROM (SELECT conv_id, turn, term, count(*) AS tf FROM ("
    "SELECT conv_id, turn, unnest(list_concat(ws, [ws[i] || ' ' || ws[i + 1] for i in range(1, greatest(len(ws), 1))])) "
    "AS term FROM pasted_words) GROUP BY ALL) JOIN vocabulary USING (term)",
    ("pasted_words", "vocabulary"),
)
sql.PARTS["pasted_text"] = (
    "SELECT conv_id, turn, sum(w * coefficient) / sqrt(sum(w * w)) AS total FROM pasted_weights "
    "JOIN odds USING (term) GROUP BY conv_id, turn",
    ("pasted_weights", "odds"),
)
sql.PARTS["pasted_scores"] = (
    "SELECT conv_id, turn, mail, 1 / (1 + exp(-(coalesce(total, 0) + "
    "(SELECT ln(sum(label)) - ln(count(*) - sum(label)) FROM split WHERE NOT is_test) + "
    + " + ".join(
        f"({f} - m_{f}) / s_{f} * (SELECT coefficient FROM metadata_weights WHERE feature = '{f}')"
        for f in _FEATURES
    )
    + "))) AS p FROM pasted_features LEFT JOIN pasted_text USING (conv_id, turn), moments",
    ("pasted_features", "pasted_text", "split", "moments", "metadata_weights"),
)
_BLANK = f"{sql.strip('mail')} = ''"
ORACLES["q_score_pasted"] = with_parts("pasted_scores") + (
    f"SELECT conv_id, turn, CASE WHEN NOT {_BLANK} THEN CAST(p >= 0.7 AS INTEGER) END AS predicted_label, "
    f"CASE WHEN {_BLANK} THEN NULL WHEN p >= 0.7 THEN 'phishing' ELSE 'legitimate' END AS prediction, "
    f"CASE WHEN NOT {_BLANK} THEN round(p, 6) END AS phishing_probability, "
    f"CASE WHEN NOT {_BLANK} THEN round(p * 100, 6) END AS risk_score, "
    f"CASE WHEN NOT {_BLANK} THEN {sql.risk_level('p * 100')} END AS risk_level, "
    f"CASE WHEN {_BLANK} THEN 'Email text cannot be empty.' END AS error FROM pasted_scores"
)
sql.PARTS["pasted_entries"] = (
    "SELECT conv_id, turn, 'text' AS kind, term AS name, value, coefficient, value * coefficient AS contribution, "
    "row_number() OVER (PARTITION BY conv_id, turn ORDER BY value * coefficient DESC, term) AS rank FROM ("
    "SELECT conv_id, turn, term, coefficient, w / sqrt(sum(w * w) OVER (PARTITION BY conv_id, turn)) AS value "
    "FROM pasted_weights JOIN odds USING (term)) WHERE value * coefficient > 0"
    + "".join(
        f" UNION ALL SELECT conv_id, turn, 'metadata', '{f}', ({f} - m_{f}) / s_{f}, coefficient, "
        f"({f} - m_{f}) / s_{f} * coefficient, 1 FROM pasted_features, moments, "
        f"(SELECT coefficient FROM metadata_weights WHERE feature = '{f}')"
        for f in _FEATURES
    ),
    ("pasted_weights", "odds", "pasted_features", "moments", "metadata_weights"),
)
ORACLES["q_explain_pasted"] = with_parts("pasted_scores", "pasted_entries") + (
    f"SELECT conv_id, turn, {sql.risk_level('p * 100')} AS risk_level, kind, name, round(value, 6) AS value, "
    "round(coefficient, 6) AS coefficient, round(contribution, 6) AS contribution "
    f"FROM pasted_entries JOIN pasted_scores USING (conv_id, turn) WHERE rank <= 10 AND NOT {_BLANK}"
)
ORACLES["q_score_stream"] = ORACLES["q_score_pasted"]
ORACLES["q_model_roundtrip"] = with_parts("full_score") + (
    "SELECT row_key, round(p, 6) AS phishing_probability FROM full_score WHERE is_test"
)
ORACLES["q_csv_ingest"] = with_parts("usable") + (
    "SELECT sender, receiver, date, subject, body, urls, text_combined, label FROM usable"
)
ORACLES["q_csv_variants"] = f"""
WITH texts AS ({csv_texts("regexp_replace({}, '[^" + chr(92) + "x00-" + chr(92) + "x7F]', chr(233), 'g')")}),
cells AS (
  SELECT '' AS sender, {sql.clean("CASE WHEN variant = 'clash' THEN concat('first ', doc_id) ELSE subject END")} AS subject,
    {sql.clean("body")} AS body, '' AS urls, CAST(CASE label WHEN 'spam' THEN 1 ELSE 0 END AS INTEGER) AS label FROM texts
  UNION ALL SELECT '', '', '', '', NULL FROM (SELECT DISTINCT variant FROM texts))
SELECT sender, subject, body, urls, trim({sql.swap("concat(subject, ' ', body, ' ', urls)", f"[{sql.SPACE}]+", " ")}, ' ') AS text_combined, label
FROM cells"""
ORACLES["q_sinks"] = with_parts("mails") + "SELECT row_key, source_file, label, text_combined FROM mails"
