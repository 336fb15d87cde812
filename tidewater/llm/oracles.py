"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SLICED_SEARCH = f"""
WITH occ AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '{_TERMS}')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM occ GROUP BY ALL),
lens AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY row),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lens),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, totals GROUP BY term, docs),
asked AS (
  SELECT item, item_id, term, count(*) AS q FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '{_TERMS}')) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)) GROUP BY ALL),
scores AS (
  SELECT item, item_id, tf.row, doc_id,
         CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lens USING (row), totals GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20"""

PHRASE_MINING = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded),
grams AS (
  SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM places, (VALUES (1), (2), (3), (4)) sizes(k) WHERE i + k - 1 <= len(words) GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS words FROM grams WHERE k > 1 AND f >= 30),
cuts AS (SELECT lang, phrase, a, unnest(range(1, size)) AS cut, words, size FROM cand),
scores AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase
                            ORDER BY (CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f), c.cut) AS pick
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1 : c.cut], ' ')
              JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.cut + 1 : c.size], ' ')),
spans AS (SELECT lang, a, words, size, unnest(range(1, size + 1)) AS i FROM cand WHERE size > 2),
inner_phrases AS (
  SELECT lang, array_to_string(words[i : i + m - 1], ' ') AS phrase, max(a) AS most
  FROM spans, (VALUES (2), (3)) lengths(m) WHERE m < size AND i + m - 1 <= size GROUP BY ALL),
kept AS (
  SELECT s.* FROM scores s LEFT JOIN inner_phrases i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE s.pick = 1 AND (i.most IS NULL OR 100 * CAST(i.most AS HUGEINT) < 80 * CAST(s.a AS HUGEINT))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
