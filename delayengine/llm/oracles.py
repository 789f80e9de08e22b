"""DuckDB SQL for the corpus queries that SQL can express."""

COLLOCATIONS = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), parts AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts
), lists AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM parts
), grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (
    SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM lists, (VALUES (1), (2), (3), (4)) AS sizes(k))
), f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
inside AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS most FROM (
    SELECT lang, ws, a, k, m, unnest(range(1, k - m + 2)) AS i FROM c, (VALUES (2), (3)) AS sizes(m) WHERE m < k)
  GROUP BY ALL
), kept AS (
  SELECT c.* FROM c LEFT JOIN inside USING (lang, phrase) WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT
), cuts AS (
  SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS head, array_to_string(ws[j + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)
), scores AS (
  SELECT cuts.lang, cuts.phrase, a, j, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail
), lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM scores) WHERE place = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
