"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

# Words of a text as its non-empty pieces between runs of ASCII white space.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP2 = rf"""
WITH texts AS (SELECT doc_id, {_WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, i, list_slice(words, i, i + 12) AS run
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 11, 1))) AS i FROM texts)
),
firsts AS (SELECT run, min(doc_id) AS first_id FROM windows GROUP BY run),
covered AS (
  SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS place
  FROM windows JOIN firsts USING (run) WHERE first_id < doc_id
),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n_kept
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts)
  ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


_HOST_WORDS = "adult|porn|xxx|casino|betting|pills|viagra|payday|warez|spam|ads|ad-track|adserver"
OP3 = rf"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parsed AS (
  SELECT page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw_host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest
),
hosts AS (SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parsed),
rules(verdict, rule_host, rule_path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
general AS (SELECT unnest(string_split('{_HOST_WORDS}', '|')) AS words),
fits AS (
  SELECT host, path, 1 AS tier, rule_host || rule_path AS rule, verdict
  FROM (SELECT DISTINCT host, path FROM hosts) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  UNION ALL
  SELECT host, path, 0, 'host:' || words, 'block'
  FROM (SELECT DISTINCT host, path FROM hosts) JOIN general
    ON regexp_matches(host, '(^|[^a-z0-9])' || words || '($|[^a-z0-9])')
),
best AS (
  SELECT * FROM fits QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY tier DESC, length(rule) DESC, rule DESC) = 1
)
SELECT page_id, host, path, CASE WHEN tier = 1 THEN rule END AS rule, coalesce(verdict, 'allow') AS verdict, rule AS matched
FROM hosts LEFT JOIN best USING (host, path)
"""

# Equal lines p and earlier q of the same distance make a run; runs of 60 characters go.
OP4 = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS idx
  FROM documents
),
seq AS (
  SELECT doc_id, line, idx, length(trim(line, ' ')) AS chars, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS place
  FROM split WHERE trim(line, ' ') <> ''
),
pairs AS (
  SELECT p.doc_id AS doc, q.doc_id AS other, p.place AS place, p.place - q.place AS shift, p.chars AS chars
  FROM seq p JOIN seq q ON p.line = q.line AND (q.doc_id < p.doc_id OR (q.doc_id = p.doc_id AND q.place < p.place))
),
islands AS (
  SELECT *, place - row_number() OVER (PARTITION BY doc, other, shift ORDER BY place) AS island FROM pairs
),
gone AS (
  SELECT DISTINCT doc AS doc_id, place
  FROM (SELECT *, sum(chars) OVER (PARTITION BY doc, other, shift, island) AS run_chars FROM islands) WHERE run_chars >= 60
),
removed AS (SELECT seq.doc_id, seq.idx FROM seq JOIN gone USING (doc_id, place)),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(line, chr(10) ORDER BY idx) AS text
  FROM split ANTI JOIN removed USING (doc_id, idx) GROUP BY doc_id
)
SELECT documents.doc_id, coalesce(len(string_split(documents.text, chr(10))), 0)::BIGINT AS lines_before,
       (coalesce(len(string_split(documents.text, chr(10))), 0) - coalesce(n_kept, 0))::BIGINT AS lines_removed,
       CASE WHEN documents.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""

OP7 = r"""
WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY text)
"""

# crc32 of UTF-8 bytes by its table, which list_reduce makes from the polynomial.
OP11 = r"""
WITH crc_table AS (
  SELECT list_transform(range(0, 256), lambda n: list_reduce(range(0, 8),
           lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n::BIGINT)) AS entries
),
texts AS (
  SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark
),
listed AS (
  SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts
),
words AS (SELECT side, doc_id, unnest(words) AS word FROM listed),
counted AS (SELECT word, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM words GROUP BY word),
bytes AS (
  SELECT word, s, t, list_transform(range(1, len(hex(encode(word))) + 1, 2),
           lambda i: ('0x' || substr(hex(encode(word)), i, 2))::BIGINT) AS b FROM counted
),
hashed AS (
  SELECT word, s, t, xor(list_reduce(b, lambda c, x: xor(c >> 8, entries[xor(c & 255, x) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM bytes, crc_table
),
totals AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counted),
gains AS (
  SELECT bucket, floor(1000 * ln((sum(t) + 1)::DOUBLE * (any_value(s_all) + 10000)
           / ((sum(s) + 1)::DOUBLE * (any_value(t_all) + 10000))))::BIGINT AS gain
  FROM hashed, totals GROUP BY bucket
),
weights AS (
  SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
),
scored AS (
  SELECT documents.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || documents.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE))))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)
),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

OP12 = r"""
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM firsts
"""

ORACLES = {
    "op2_substring_dedup": OP2,
    "op3_url_filters": OP3,
    "op4_line_dedup": OP4,
    "op7_exact_dedup": OP7,
    "op11_importance_resampling": OP11,
    "op12_warc": OP12,
}
