"""DuckDB twins of the queries that SQL can express on whole tables."""
from __future__ import annotations

from .quality_rules import STOP_FORMS

QUOTED = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_FORMS)

ORACLE: dict[str, str] = {
    "op8_url_rules": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
    "op3_quality_rules": r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
counted AS (
  SELECT r, doc_id, words, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
         length(text) - length(replace(text, '!', '')) AS n_exclamations FROM split),
each AS (SELECT r, unnest(words) AS w FROM counted),
stops AS (SELECT r, count(*) AS n_stop FROM each WHERE w IN (""" + QUOTED + r""") GROUP BY r),
windows AS (SELECT r, i, array_to_string(words[i + 1:i + 5], ' ') AS win FROM (SELECT r, words, unnest(range(n_words - 4)) AS i FROM counted WHERE n_words >= 5) AS t),
twice AS (SELECT r, win FROM windows GROUP BY r, win HAVING count(*) > 1),
covered AS (SELECT r, count(DISTINCT place) AS n FROM (
  SELECT windows.r AS r, windows.i + k.k AS place FROM windows JOIN twice ON windows.r = twice.r AND windows.win = twice.win
  CROSS JOIN (SELECT unnest(range(5)) AS k) AS k) AS c GROUP BY r),
base AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_exclamations, coalesce(n_stop, 0) AS n_stop,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM counted LEFT JOIN stops ON counted.r = stops.r LEFT JOIN covered ON counted.r = covered.r),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 25.0 * n_words
       AND CAST(n_symbols AS DOUBLE) / n_words <= 0.3 AND CAST(n_exclamations AS DOUBLE) / n_words <= 0.5
       AND CAST(n_stop AS DOUBLE) / n_words >= 0.02 AND CAST(n_dup_lines AS DOUBLE) / n_lines <= 0.3 AS kept
FROM judged""",
}
