"""DuckDB SQL with the same rows as the registered queries, where SQL can express them."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"
#: Largest percentage of characters in repeated n-grams, by n.
_GRAMS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}


def _quality() -> str:
    """Repetition within each text; an n-gram is its words joined by blanks, which words don't hold."""
    parts = [f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM t)),
ld AS (SELECT doc_id, line, i, list_sum(list_transform(regexp_extract_all(line, {_WORD}), lambda x: length(x))) AS chars, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS k FROM l WHERE regexp_matches(line, {_WORD})),
w AS (SELECT doc_id, word, line_again, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS i FROM (
    SELECT doc_id, i, k > 1 AS line_again, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM (SELECT *, regexp_extract_all(line, {_WORD}) AS ws FROM ld))),
lines AS (SELECT doc_id, count(*) FILTER (k > 1) AS n_dup_lines, coalesce(sum(chars) FILTER (k > 1), 0)::BIGINT AS dup_line_chars FROM ld GROUP BY 1),
base AS (SELECT doc_id, len(regexp_extract_all(text, {_WORD})) AS n_words, coalesce(list_sum(list_transform(regexp_extract_all(text, {_WORD}), lambda x: length(x))), 0)::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols FROM t)"""]
    for n in (3, *_GRAMS):
        gram = " || ' ' || ".join(f"lead(word, {j}) OVER d" if j else "word" for j in range(n))
        again = "count(*) OVER (PARTITION BY doc_id, g) > 1" if n == 3 else "row_number() OVER (PARTITION BY doc_id, g ORDER BY i) > 1"
        value = "count(*)" if n == 3 else "sum(CASE WHEN line_again THEN 0 ELSE length(word) END)"
        parts.append(f"""
g{n} AS (SELECT doc_id, i, word, line_again, {gram} AS g FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
a{n} AS (SELECT doc_id, i, word, line_again, g IS NOT NULL AND {again} AS again FROM g{n}),
c{n} AS (SELECT doc_id, {value}::BIGINT AS n FROM (SELECT doc_id, word, line_again, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside FROM a{n}) WHERE inside GROUP BY 1)""")
    grams = ", ".join(f"coalesce(c{n}.n, 0) AS dup{n}_chars" for n in _GRAMS)
    joins = " ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in (3, *_GRAMS))
    bad = " OR ".join(f"100 * dup{n}_chars > {most} * word_chars" for n, most in _GRAMS.items())
    return ",".join(parts) + f""",
m AS (SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(c3.n, 0) AS n_repeat_words, coalesce(dup_line_chars, 0) AS dup_line_chars, {grams} FROM base LEFT JOIN lines USING (doc_id) {joins}),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT (base_failed OR 100 * dup_line_chars > 20 * word_chars OR 100 * n_symbols > 10 * n_words OR {bad}) AS kept FROM f"""


def _warc() -> str:
    """Roles by equal payloads; what is read back must agree."""
    return """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f"""


def _chat() -> str:
    """Windows of 512 tokens with 96 of history in up to 2 turns; a piece is its escaped role and text and 16 characters of markers."""
    esc = "replace(replace({}, '&', '&amp;'), '<', '&lt;')"
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
t AS (SELECT *, len(regexp_extract_all(text, {_WORD})) + 4 AS tokens, 16 + length(replace({esc.format("role")}, '>', '&gt;')) + length({esc.format("text")}) AS size, row_number() OVER o AS pos,
    first_value(role) OVER o = 'system' AS has_system FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (SELECT *, has_system AND pos = 1 AS is_system, CASE WHEN has_system THEN first_value(size) OVER o ELSE 0 END AS system_size,
    greatest((416 - CASE WHEN has_system THEN first_value(tokens) OVER o ELSE 0 END) // 2, 1) AS half FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY pos)),
b AS (SELECT *, CASE WHEN is_system THEN 0 ELSE tokens END AS own FROM s),
p AS (SELECT *, (sum(own) OVER (PARTITION BY conv_id ORDER BY pos) - own) // half AS bucket FROM b),
g AS (SELECT *, NOT is_system AND (pos = CASE WHEN has_system THEN 2 ELSE 1 END OR bucket <> lag(bucket) OVER o OR own > half OR lag(own) OVER o > half) AS begins,
    lag(own) OVER o AS own1, lag(own, 2) OVER o AS own2, lag(size) OVER o AS size1, lag(size, 2) OVER o AS size2, lag(is_system) OVER o AS sys1, lag(is_system, 2) OVER o AS sys2
    FROM p WINDOW o AS (PARTITION BY conv_id ORDER BY pos)),
w AS (SELECT *, greatest(sum(begins::INT) OVER (PARTITION BY conv_id ORDER BY pos) - 1, 0) AS win FROM g),
x AS (SELECT *, size + CASE WHEN begins AND win > 0 THEN system_size
    + CASE WHEN NOT coalesce(sys1, true) AND own1 <= 96 THEN size1 ELSE 0 END
    + CASE WHEN NOT coalesce(sys2, true) AND own1 + own2 <= 96 THEN size2 ELSE 0 END ELSE 0 END AS chars FROM w)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, (max(win) + 1)::BIGINT AS n_windows
FROM x GROUP BY conv_id"""


SQL = {"op1_repetition_coverage": _quality(), "op4_budgeted_windows": _chat(), "op6_warc_archives": _warc()}
