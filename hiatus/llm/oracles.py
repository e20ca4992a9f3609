"""SQL equivalents of the operators' queries, where SQL can express them."""

from __future__ import annotations

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER = f"translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9_DECONTAMINATION = f"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size,
           unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda i: array_to_string(w[i:i + 9], ' '))) AS words
    FROM items WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT size FROM windows),
docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
places AS (
    SELECT r, size, unnest(range(1, len(w) - size + 2)) AS place, w
    FROM docs, sizes WHERE len(w) >= size
),
found AS (
    SELECT r, place, size, item_id
    FROM (SELECT r, place, size, array_to_string(w[place:place + size - 1], ' ') AS words FROM places)
    JOIN windows USING (size, words)
),
hits AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(place, place + size)) AS p FROM found) GROUP BY r
),
ids AS (
    SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS joined
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN ids USING (r)
"""


def unit_hash(*parts: str) -> str:
    joined = " || '|' || ".join(parts)
    return f"(('0x' || substr(md5({joined}), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0"


OP6_POISSON_MIX = f"""
WITH totals AS (SELECT source, sum(strlen(coalesce(text, ''))) AS n_bytes FROM documents GROUP BY source),
rates AS (
    SELECT source,
           CASE WHEN n_bytes > 0
                THEN 1.0::DOUBLE / (SELECT count(*) FROM totals WHERE n_bytes > 0)::DOUBLE
                     * (SELECT sum(n_bytes) FROM totals)::DOUBLE / n_bytes::DOUBLE
                ELSE 1.0::DOUBLE END AS rate
    FROM totals
),
terms AS (
    SELECT source, rate, k,
           sum(CASE WHEN i = 0 THEN 0 ELSE ln(rate) - ln(i) END) OVER (PARTITION BY source ORDER BY k) - rate AS log_p
    FROM (SELECT source, rate, unnest(range(0, 200)) AS k FROM rates), LATERAL (SELECT k AS i)
),
steps AS (SELECT source, k, sum(exp(log_p)) OVER (PARTITION BY source ORDER BY k) AS total FROM terms),
numbered AS (
    SELECT *, coalesce(doc_id::VARCHAR, '\\N') || '|' || digest || '|'
              || (row_number() OVER (PARTITION BY doc_id, digest ORDER BY lang, source, n_chars) - 1)::VARCHAR AS name
    FROM (SELECT *, md5(coalesce(text, '')) AS digest FROM documents)
),
draws AS (SELECT *, {unit_hash("'17'", "name", "'0'")} AS u FROM numbered),
counted AS (
    SELECT d.*, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND s.total < d.u) AS copies
    FROM draws d
),
copied AS (SELECT *, unnest(range(0, copies)) AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, copy,
       md5('17|order|' || name || '|' || copy::VARCHAR) AS mix_key
FROM copied
"""

ORACLES: dict[str, str] = {
    "op6_poisson_mix": OP6_POISSON_MIX,
    "op9_decontamination": OP9_DECONTAMINATION,
}
