r"""DuckDB SQL for the operators that SQL can express: the rule ledger, the archives and the chat round trip.

The others rest on hashes, models or groupings that DuckDB has no function for; they are tested against
brute force in tests/llm.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{word}') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS ls FROM d),
g AS (SELECT r, i, list_slice(ws, i, i + 7) AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
again AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range(8) AS o(k) GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines
  FROM w LEFT JOIN covered USING (r)
),
f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    ((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
     + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT
     + 64 * (100 * n_repeat_words > 20 * n_words)::INT + 128 * (100 * n_dup_lines > 30 * n_lines)::INT)::INT AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND fail_bits & 63 = 0 AS kept, n_lines, fail_bits FROM f
""".replace("{word}", _WORD)

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages),
q AS (
  SELECT *, last IS NOT NULL AND page_id IS DISTINCT FROM last AS again,
    array_to_string(list_transform(string_split(sha1(h), ''), lambda x: right('000' || bin(strpos('0123456789abcdef', x) - 1), 4)), '') AS bits
  FROM p
)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', list_sum(list_transform(range(5), lambda j: (substr(bits, 5 * k + j + 1, 1)::INT << (4 - j))))::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN last END AS refers_to
FROM q
"""

_CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
e AS (
  SELECT *, length(regexp_replace(text, '(\\*)(\[INST\]|\[/INST\]|</s>|\[ROLE=|\[/ROLE\])', '\1\1\\\2', 'g')) AS n,
    CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 ELSE 16 + length(url_encode(role)) END AS marks
  FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n + marks)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

SQL: dict[str, str] = {"op5_quality_rules": _RULES, "op7_warc": _WARC, "op8_chat": _CHAT}
