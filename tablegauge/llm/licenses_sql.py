"""The licence scan of ``op3_license_scan`` in DuckDB SQL."""

from __future__ import annotations

from tablegauge.llm.licenses import TEMPLATES, THRESHOLD

_ROWS = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in TEMPLATES)
_TRIGGER = "(?i)licen[cs]e|copyright|spdx|copying permission|all rights reserved|public domain"

SQL = f"""
WITH known(license, text) AS (VALUES {_ROWS}),
t_tf AS (SELECT license, word, count(*) AS tf FROM (SELECT license, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS word FROM known)
         WHERE word <> '' GROUP BY ALL),
idf AS (SELECT word, ln((1.0 + (SELECT count(*) FROM known)) / (1 + count(DISTINCT license))) + 1 AS idf FROM t_tf GROUP BY word),
t_w AS (SELECT license, word, tf * idf AS weight FROM t_tf JOIN idf USING (word)),
t_norm AS (SELECT license, sqrt(sum(weight * weight)) AS norm FROM t_w GROUP BY license),
files AS (SELECT doc_id, source AS repo, coalesce(text, '') AS text, concat_ws('/', lang,
    CASE WHEN doc_id % 1000 = 0 THEN 'LICENSE' WHEN doc_id % 25 = 0 THEN 'd' || (doc_id // 100) || '/LICENSE'
         ELSE 'd' || (doc_id // 100) || '/' || doc_id || '.txt' END) AS path, doc_id % 25 = 0 AS held FROM documents),
placed AS (SELECT *, regexp_replace(path, '/?[^/]*$', '') AS dir FROM files),
units AS (SELECT DISTINCT doc_id, unit FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM placed WHERE regexp_matches(text, '{_TRIGGER}')
    ) WHERE regexp_matches(unit, '{_TRIGGER}')
    UNION SELECT doc_id, text FROM placed WHERE held),
u_tf AS (SELECT doc_id, unit, word, count(*) AS tf FROM (
    SELECT doc_id, unit, unnest(regexp_split_to_array(lower(unit), '[^a-z0-9]+')) AS word FROM units) WHERE word <> '' GROUP BY ALL),
u_w AS (SELECT doc_id, unit, u_tf.word, tf * coalesce(idf, ln(1.0 + (SELECT count(*) FROM known)) + 1) AS weight FROM u_tf LEFT JOIN idf USING (word)),
u_norm AS (SELECT doc_id, unit, sqrt(sum(weight * weight)) AS norm FROM u_w GROUP BY ALL),
dots AS (SELECT doc_id, unit, license, sum(u_w.weight * t_w.weight) AS dot FROM u_w JOIN t_w USING (word) GROUP BY ALL),
scored AS (SELECT doc_id, license, round(dot / u_norm.norm / t_norm.norm, 9) AS cosine
    FROM dots JOIN u_norm USING (doc_id, unit) JOIN t_norm USING (license)),
own AS (SELECT doc_id, license, cosine FROM scored WHERE cosine >= {THRESHOLD}
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, license) = 1),
held AS (SELECT repo, dir, license FROM placed JOIN own USING (doc_id) WHERE held
    QUALIFY row_number() OVER (PARTITION BY repo, dir ORDER BY cosine DESC, license) = 1),
near AS (SELECT f.doc_id, h.license, h.dir FROM placed f JOIN held h ON f.repo = h.repo AND (f.dir = h.dir OR starts_with(f.dir, h.dir || '/'))
    QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(h.dir) DESC) = 1)
SELECT f.doc_id, f.path, coalesce(own.license, near.license) AS license,
    CASE WHEN own.license IS NOT NULL THEN 'own' WHEN near.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
    round(own.cosine, 6) AS cosine, CASE WHEN own.license IS NULL THEN near.dir END AS from_dir
FROM placed f LEFT JOIN own USING (doc_id) LEFT JOIN near USING (doc_id)
"""
