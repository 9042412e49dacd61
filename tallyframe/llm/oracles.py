"""DuckDB SQL that states the results of the operators in another way."""

from __future__ import annotations

from tallyframe.llm import quality

BLANKS = "[ \\t\\n\\x0B\\f\\r]+"
WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANKS}'), lambda w: w <> '')"


#: CRC-32 of a word's UTF-8 bytes, from the rule of its polynomial.
CRC = """
crc_table AS (
  SELECT list(v ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS v
    FROM range(256) r(n))
), crcs AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
    xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM crc_table, (
    SELECT w, list_transform(range(strlen(w)), lambda i:
      ('0x' || substr(hex(encode(w)), (2 * i + 1)::INT, 2))::BIGINT) AS bytes
    FROM (SELECT DISTINCT w FROM words))
"""

QUALITY = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents
), words AS (
  SELECT doc_id, i::BIGINT AS i, words[i] AS w, array_to_string(words[i:i+4], ' ') AS win,
         i + 4 <= len(words) AS whole
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs)
), repeated AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM words WHERE whole)
  WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS j FROM repeated) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]') GROUP BY doc_id
), {CRC.strip()}
), hashed AS (
  SELECT doc_id, h, lead(h) OVER (PARTITION BY doc_id ORDER BY i) AS h2
  FROM words JOIN crcs USING (w)
), grams AS (
  SELECT doc_id, h % {quality.BUCKETS} AS b FROM hashed
  UNION ALL
  SELECT doc_id, (31 * h + h2) % {quality.BUCKETS} AS b FROM hashed WHERE h2 IS NOT NULL
), trusted AS (
  SELECT DISTINCT doc_id, ((doc_id % 1000003) * 7919) % 1000003 AS o FROM labels
  WHERE quality = 1 AND coalesce(toxic, 0) = 0 ORDER BY o, doc_id LIMIT {quality.MOST_TRUSTED}
), counts AS (
  SELECT b, count(*) AS n_raw,
         count(*) FILTER (doc_id IN (SELECT doc_id FROM trusted)) AS n_good
  FROM grams GROUP BY b
), model AS (
  SELECT b, ln((n_good / (n_raw / sum(n_raw) OVER ()) + {quality.BUCKETS})
            / (sum(n_good) OVER () + {quality.BUCKETS})) AS v
  FROM counts
), scores AS (
  SELECT doc_id, avg(v) AS score FROM grams JOIN model USING (b) GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT m.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND coalesce(score >= {quality.THRESHOLD}, FALSE) AS kept
FROM measured m LEFT JOIN scores USING (doc_id)
"""

LINES = """
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), owners AS (
  SELECT k, min(doc_id) AS owner FROM lines WHERE length(k) >= 10 GROUP BY k
), judged AS (
  SELECT doc_id, i, line, coalesce(owner = doc_id, TRUE) AS stays
  FROM lines LEFT JOIN owners USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

COPIES = """
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       coalesce(doc_id = max(doc_id) OVER same, max(doc_id) OVER same IS NULL) AS kept,
       sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""

RECORDS = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS p FROM pages
), judged AS (
  SELECT page_id, p, max(page_id) OVER (PARTITION BY p) AS first FROM payloads
), kinds AS (
  SELECT page_id, p, first, first <> page_id AND strlen(p) >= 1000 AS again FROM judged
)
SELECT page_id, strlen(p)::BIGINT AS payload_bytes, sha1(p) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to
FROM kinds
"""
