"""DuckDB SQL of the training-data queries that SQL can express, over whole tables."""

from __future__ import annotations

SUFFIXES = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), chunks AS (
  SELECT r, doc_id, j, substr(h, 512 * j + 1, 610) AS s FROM d, unnest(range(0, (length(h) + 511) // 512)) AS t(j)
), bytes AS (
  SELECT r, doc_id, 256 * j + i AS i, substr(s, 2 * i - 1, 2) AS b, CASE WHEN 2 * i + 98 <= length(s) THEN substr(s, 2 * i - 1, 100) END AS k
  FROM chunks, unnest(range(1, least(256, length(s) // 2) + 1)) AS t(i)
), strings AS (
  SELECT r, i, b, k IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY k) AS again FROM bytes
), covered AS (
  SELECT r, i, b, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS c FROM strings
), runs AS (
  SELECT r, i, b, c, c AND NOT lag(c, 1, false) OVER (PARTITION BY r ORDER BY i) AS opens FROM covered
), kept AS (
  SELECT r, count(*) AS n_bytes, count_if(c) AS n_removed, count_if(opens) AS n_spans, string_agg(b, '' ORDER BY i) FILTER (WHERE NOT c) AS h
  FROM runs GROUP BY r
)
SELECT doc_id, coalesce(n_bytes, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

SUBSTRINGS = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
  SELECT r, doc_id, i, w[i] AS word, CASE WHEN i + 19 <= len(w) THEN array_to_string(w[i:i + 19], ' ') END AS k
  FROM d, unnest(range(1, len(w) + 1)) AS t(i)
), windows AS (
  SELECT r, i, word, k IS NOT NULL AND rank() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS again FROM words
), covered AS (
  SELECT r, i, word, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS c FROM windows
), kept AS (
  SELECT r, count(*) AS n_words, count_if(c) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT c) AS text FROM covered GROUP BY r
)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

ORACLE = {"op5_suffixes": SUFFIXES, "op8_substrings": SUBSTRINGS}
