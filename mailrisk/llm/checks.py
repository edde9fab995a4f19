"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_quality_lines"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, place0, array_to_string(words[place0:place0 + 7], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS place0 FROM docs)),
repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(generate_series(place0, place0 + 7)) AS place FROM windows
    SEMI JOIN (SELECT doc_id, gram FROM windows GROUP BY ALL HAVING count(*) > 1) twice USING (doc_id, gram))
  GROUP BY doc_id),
raw_lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs),
dup_lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM raw_lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
normal AS (
  SELECT doc_id, host, raw,
    trim(regexp_replace(lower(regexp_replace(raw, '[\x20\x09-\x0D]', ' ', 'g')), ' {2,}', ' ', 'g'), ' ') AS line
  FROM (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS raw FROM docs)),
texts AS (SELECT host, t, min(doc_id) AS doc_id FROM docs GROUP BY ALL),
over_limit AS (
  SELECT host, line FROM (
    SELECT DISTINCT normal.doc_id, normal.host, line FROM normal SEMI JOIN texts USING (doc_id) WHERE line <> '') held
  GROUP BY host, line HAVING count(*) > 10),
removed AS (
  SELECT doc_id, count(*) AS lines, sum(len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+'))) AS words
  FROM normal SEMI JOIN over_limit USING (host, line) GROUP BY doc_id),
base AS (
  SELECT doc_id, len(docs.words) AS n_words, length(array_to_string(docs.words, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup_lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    CAST(coalesce(removed.lines, 0) AS BIGINT) AS n_removed_lines,
    CAST(coalesce(removed.words, 0) AS BIGINT) AS n_removed_words
  FROM docs LEFT JOIN dup_lines USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN removed USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (n_removed_words > 0.7 * n_words) AS kept,
  n_removed_lines, n_removed_words
FROM base
"""


def _spans_of(kind: str, pattern: str, accepted: str) -> str:
    """Spans by summing the lengths of matches and of the text between them."""
    return rf"""
SELECT doc_id, '{kind}' AS kind, stop - length(hit) AS start, stop, hit FROM (
  SELECT doc_id, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY place) AS stop
  FROM (SELECT doc_id, unnest(string_split_regex(t, {pattern})) AS gap,
      unnest(regexp_extract_all(t, {pattern})) AS hit, generate_subscripts(string_split_regex(t, {pattern}), 1) AS place
    FROM docs WHERE regexp_matches(t, {pattern})) WHERE hit IS NOT NULL)
WHERE {accepted}"""


_ASSIGN = (
    r"""'(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'"""
)
_LOGIN = (
    r"""'(?i:user_?name|user_?id|login|client_?id|account_?id)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9@._-]+'"""
)
_NEAR = "o.doc_id = w.doc_id AND o.start <= w.stop + 200 AND o.stop + 200 >= w.start"

ORACLES["op3_secret_links"] = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS (
  SELECT *, 'secret' AS role, 1 AS rank FROM ({_spans_of("assign", _ASSIGN,
      "length(regexp_extract(hit, '[:=]' || chr(92) || 'x20*[' || chr(34) || chr(39) || ']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 8")})
  UNION ALL SELECT *, 'identifier', 2 FROM ({_spans_of("access", "'AKIA[A-Z0-9]+'", "length(hit) >= 16")})
  UNION ALL SELECT *, 'secret', 3 FROM ({_spans_of("hex", "'[0-9a-f]{32,}'", "true")})
  UNION ALL SELECT *, 'identifier', 4 FROM ({_spans_of("login", _LOGIN,
      "length(regexp_extract(hit, '[:=]' || chr(92) || 'x20*[' || chr(34) || chr(39) || ']?(.*)$', 1)) >= 3")})
  UNION ALL SELECT *, 'secret', 5 FROM ({_spans_of("key", "'[A-Za-z0-9+/]{40,}'",
      "length(hit) = 40 AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[0-9]')")})
  UNION ALL SELECT *, 'endpoint', 6 FROM ({_spans_of("endpoint", r"'https?://[^\x20\x09-\x0D\"''<>]+'", "true")})),
weak AS (
  SELECT * FROM spans w WHERE rank > 3 AND NOT EXISTS (
    SELECT 1 FROM spans o WHERE o.rank <= 3 AND o.doc_id = w.doc_id AND o.role = w.role
      AND o.start <= w.start AND w.stop <= o.stop)),
kept AS (
  SELECT * FROM spans WHERE rank <= 3
  UNION ALL SELECT * FROM weak w WHERE
    (role = 'secret' OR EXISTS (SELECT 1 FROM spans o WHERE {_NEAR} AND o.role = 'secret'))
    AND (role = 'identifier' OR EXISTS (SELECT 1 FROM spans o WHERE {_NEAR} AND o.role = 'identifier'))),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, rank) FILTER (rank <= 3) AS base,
    string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, rank) AS spans
  FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (doc_id)
"""

_CONTROL = r"'<\|[A-Za-z0-9_]+\|>|</?s>|<</?SYS>>|\[/?INST\]'"
_ESCAPED = (
    "length({0}) + length({0}) - length(replace({0}, '~', '')) + len(regexp_extract_all({0}, " + _CONTROL + "))"
)

ORACLES["op4_reply_trees"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + {_ESCAPED.format("role")} + 1 + {_ESCAPED.format("text")} + 11) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_FOLDED = (
    r"list_filter(regexp_split_to_array(lower_ascii, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda word : word <> '')"
)
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op8_prefix_join"] = f"""
WITH docs AS (SELECT doc_id, {_FOLDED} AS words FROM (SELECT doc_id, {_LOWER} AS lower_ascii FROM documents)),
items AS (
  SELECT item_id, words FROM (
    SELECT item_id, {_FOLDED} AS words FROM (SELECT item_id, {_LOWER} AS lower_ascii FROM benchmark))
  WHERE len(words) > 0),
windows AS (
  SELECT item_id, size, array_to_string(words[place0:place0 + size - 1], ' ') AS gram
  FROM (SELECT item_id, words, least(len(words), 10) AS size,
      unnest(generate_series(1, greatest(len(words) - 9, 1))) AS place0 FROM items)),
grams AS (
  SELECT doc_id, size, place0, array_to_string(words[place0:place0 + size - 1], ' ') AS gram
  FROM (SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS place0
    FROM docs, (SELECT DISTINCT size FROM windows))),
found AS (SELECT DISTINCT doc_id, item_id, place0, size FROM grams JOIN windows USING (size, gram)),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(generate_series(place0, place0 + size - 1)) AS place FROM found) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(listed.n, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
