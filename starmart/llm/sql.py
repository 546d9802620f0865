"""The queries that SQL can express, as DuckDB runs them on the given tables."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, p, p + 4), ' ') AS gram
  FROM worded, LATERAL (SELECT unnest(generate_series(1, greatest(len(words) - 4, 1))) AS p) WHERE len(words) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b USING (gram)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM worded UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.b) AS component_id, w.doc_id = min(r.b) AS kept
FROM worded w JOIN reach r ON r.a = w.doc_id LEFT JOIN sizes s ON s.doc_id = w.doc_id GROUP BY w.doc_id
"""

OP3 = rf"""
WITH worded AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(list_slice(words, p, p + 12), ' ') AS passage
  FROM worded, LATERAL (SELECT unnest(generate_series(1, len(words) - 12)) AS p) WHERE len(words) > 12
),
owners AS (SELECT passage, min(doc_id) AS owner FROM windows GROUP BY passage),
gone AS (
  SELECT DISTINCT doc_id, p + k AS place
  FROM windows JOIN owners USING (passage) CROSS JOIN (SELECT unnest(generate_series(0, 12)) AS k)
  WHERE owner < doc_id
),
placed AS (
  SELECT doc_id, p AS place, words[p] AS word FROM worded, LATERAL (SELECT unnest(generate_series(1, len(words))) AS p)
),
left_over AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
  FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM worded w LEFT JOIN left_over USING (doc_id)
"""

_LETTERS = rf"""regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP4 = rf"""
WITH worded AS (SELECT doc_id, {_LETTERS} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_LETTERS} AS words FROM benchmark),
passages AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS size,
         array_to_string(list_slice(words, p, p + least(13, len(words)) - 1), ' ') AS passage
  FROM items, LATERAL (SELECT unnest(generate_series(1, len(words) - least(13, len(words)) + 1)) AS p) WHERE len(words) > 0
),
lengths AS (SELECT DISTINCT size FROM passages),
windows AS (
  SELECT doc_id, p, size, array_to_string(list_slice(words, p, p + size - 1), ' ') AS passage
  FROM worded, lengths, LATERAL (SELECT unnest(generate_series(1, len(words) - size + 1)) AS p) WHERE len(words) >= size
),
found AS (SELECT DISTINCT doc_id, p, size, item_id FROM windows JOIN passages USING (size, passage)),
hits AS (
  SELECT doc_id, count(DISTINCT p + k) AS n FROM found, LATERAL (SELECT unnest(generate_series(0, size - 1)) AS k)
  GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM found GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(words) AS contaminated
FROM worded w LEFT JOIN hits h USING (doc_id) LEFT JOIN named m USING (doc_id)
"""

OP6 = """
WITH sized AS (
  SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM documents GROUP BY source
),
weighed AS (SELECT source, size, pow(size, 0.7) AS weight FROM sized WHERE size > 0),
rated AS (
  SELECT source, weight / (SELECT sum(weight) FROM weighed) * (SELECT sum(size) FROM sized) / size AS rate FROM weighed
),
chances AS (
  SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1.0)) AS p, rate
  FROM rated, LATERAL (SELECT unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT))) AS k)
),
steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS upto FROM chances),
drawn AS (
  SELECT *, (CAST(('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 0.5)
            / 4503599627370496.0 AS u
  FROM documents
),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(*) AS copies
  FROM drawn d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source AND s.upto < d.u GROUP BY ALL
)
SELECT doc_id, text, lang, source, n_chars, CAST(k AS INTEGER) AS copy
FROM counted, LATERAL (SELECT unnest(generate_series(0, copies - 1)) AS k)
"""

_TERMS = rf"""regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP13 = rf"""
WITH terms AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL
),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM terms GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * docs + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w
  FROM terms, whole GROUP BY term, docs
),
asked AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN terms USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), whole GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

SQL = {
    "op2_minhash_near_dedup": OP2,
    "op3_substring_dedup": OP3,
    "op4_benchmark_decontamination": OP4,
    "op6_source_mixing": OP6,
    "op13_lexical_search": OP13,
}
