"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD = rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM cut),
rows AS (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM rows a JOIN rows b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.a, e.y FROM reach r JOIN both_ways e ON r.b = e.x)
SELECT doc_id, CAST(any_value(n) AS BIGINT) AS n_shingles, min(b) AS component_id
FROM sizes JOIN reach ON a = doc_id GROUP BY doc_id
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM cut GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM cut, (SELECT unnest(range(1, 6)) AS k)),
f AS (SELECT lang, k, phrase, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 100),
inner_ones AS (
  SELECT lang, c, unnest([array_to_string(string_split(phrase, ' ')[1:k - 1], ' '), array_to_string(string_split(phrase, ' ')[2:k], ' ')]) AS phrase
  FROM f WHERE k >= 3),
kept AS (SELECT * FROM f WHERE k >= 2 AND (lang, c, phrase) NOT IN (SELECT lang, c, phrase FROM inner_ones)),
cuts AS (SELECT *, unnest(range(1, k)) AS j, string_split(phrase, ' ') AS w FROM kept),
scored AS (
  SELECT x.lang, x.phrase, x.c AS a, j, p.c AS l, q.c AS r, n, 1000::HUGEINT * x.c * n // (p.c::HUGEINT * q.c) AS score
  FROM cuts x JOIN totals USING (lang)
  JOIN f p ON p.lang = x.lang AND p.phrase = array_to_string(w[1:j], ' ')
  JOIN f q ON q.lang = x.lang AND q.phrase = array_to_string(w[j + 1:x.k], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= 2000
"""
