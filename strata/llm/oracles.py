"""SQL statements of the queries whose results do not depend on a hash, a model or an iteration
that DuckDB lacks: contamination, near duplicates and repeated strings.  They state the results
directly (all phrases, all pairs, all windows), not by the operators' methods."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BLANK = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

# Items of fewer than 10 words are one phrase; a word is hit where an occurrence of a phrase holds it.
CONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
items AS (SELECT item_id, {_ALNUM} AS w FROM benchmark WHERE item_id IS NOT NULL),
wanted AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
                  unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda k: array_to_string(w[k:k + 9], ' '))) AS phrase
           FROM items WHERE len(w) > 0),
places AS (SELECT r, n, unnest(list_transform(range(1, len(w) - n + 2), lambda k: {{'k': k, 'phrase': array_to_string(w[k:k + n - 1], ' ')}})) AS p
           FROM docs JOIN (SELECT DISTINCT n FROM wanted) sizes ON len(w) >= n),
met AS (SELECT r, item_id, p.k AS k, n FROM places JOIN wanted USING (n) WHERE p.phrase = wanted.phrase),
words AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS place FROM met) GROUP BY r),
names AS (SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM met) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN names USING (r)"""

# Distinct 5-word shingles (or the whole sequence), links by the exact share, the smallest doc_id in reach.
NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_BLANK} AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1), lambda k: array_to_string(w[k:k + 4], ' '))) AS s FROM docs),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
          GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) least_id ON doc_id = a"""

# Bytes as pairs of hex digits; of equal 100-byte strings all but the earliest cover their bytes.
REPEATS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS g FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM docs)),
later AS (SELECT doc_id, p FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1),
opened AS (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 100, true) AS opens FROM later),
numbered AS (SELECT doc_id, p, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM opened),
spans AS (SELECT doc_id, min(p) AS lo, max(p) + 100 AS hi FROM numbered GROUP BY doc_id, span),
gaps AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM spans),
kept AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans,
                string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) || substr(any_value(h), 2 * max(hi) + 1) AS rest
         FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""
