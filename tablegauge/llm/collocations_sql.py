"""Collocations as DuckDB SQL: all windows of up to four words, counted."""

SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
spelt AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM spelt GROUP BY lang),
windows AS (
  SELECT lang, ws, m, unnest(generate_series(1, len(ws) - m + 1)) AS i
  FROM spelt, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(ws) >= m),
f AS (
  SELECT lang, m, ws[i:i + m - 1] AS p, count(*) AS f FROM windows GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, x.f AS l, y.f AS r, c.k, (CAST(2000000 AS HUGEINT) * c.f) // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM f WHERE m > 1) c
  JOIN f x ON x.lang = c.lang AND x.p = c.p[1:c.k] JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1:c.m]),
cut AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, f, p[i:i + s - 1] AS p FROM (SELECT *, unnest(generate_series(1, m - s + 1)) AS i
    FROM (SELECT *, unnest(generate_series(2, m - 1)) AS s FROM f WHERE m > 2))),
longer AS (SELECT lang, p, max(f) AS longer FROM inner_phrases GROUP BY ALL),
kept AS (
  SELECT cut.*, array_to_string(cut.p, ' ') AS phrase FROM cut LEFT JOIN longer USING (lang, p)
  WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
