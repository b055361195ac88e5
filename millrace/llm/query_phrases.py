from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.llm.phrases import collocations, frequent_phrases
from millrace.llm.queries import query

SQL = r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
cut AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
ones AS (SELECT lang, phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS phrase FROM cut) GROUP BY ALL),
whole AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM ones GROUP BY lang),
twos AS (SELECT lang, x AS w1, y AS w2, count(*) AS f FROM (SELECT lang, unnest(w[:-2]) AS x, unnest(w[2:]) AS y FROM cut WHERE len(w) > 1) GROUP BY ALL HAVING count(*) >= 10),
threes AS (SELECT lang, x AS w1, y AS w2, z AS w3, count(*) AS f FROM (SELECT lang, unnest(w[:-3]) AS x, unnest(w[2:-2]) AS y, unnest(w[3:]) AS z FROM cut WHERE len(w) > 2) GROUP BY ALL HAVING count(*) >= 10),
covered AS (SELECT lang, w1, w2, max(f) AS longer FROM (SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) GROUP BY ALL),
two AS (SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, x.f AS l, y.f AS r, CAST(1000000 AS HUGEINT) * t.f * t.f // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.phrase = t.w1 JOIN ones y ON y.lang = t.lang AND y.phrase = t.w2
  LEFT JOIN covered c ON c.lang = t.lang AND c.w1 = t.w1 AND c.w2 = t.w2 WHERE c.longer IS NULL OR 100 * c.longer < 50 * t.f),
three AS (SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x1.f AS l1, y1.f AS r1, x2.f AS l2, y2.f AS r2,
    CAST(1000000 AS HUGEINT) * t.f * t.f // (CAST(x1.f AS HUGEINT) * y1.f) AS s1, CAST(1000000 AS HUGEINT) * t.f * t.f // (CAST(x2.f AS HUGEINT) * y2.f) AS s2
  FROM threes t JOIN ones x1 ON x1.lang = t.lang AND x1.phrase = t.w1 JOIN twos y1 ON y1.lang = t.lang AND y1.w1 = t.w2 AND y1.w2 = t.w3
  JOIN twos x2 ON x2.lang = t.lang AND x2.w1 = t.w1 AND x2.w2 = t.w2 JOIN ones y2 ON y2.lang = t.lang AND y2.phrase = t.w3),
scored AS (SELECT lang, phrase, a, l, r, score FROM two
  UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM three),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN whole USING (lang) WHERE rank <= 2000"""


@query("op13_phrases", SQL)
def op13_phrases(t) -> DataFrame:
    """The 2000 best collocations of each language, from all documents."""
    whole, phrases = frequent_phrases(t.documents)
    return collocations(t.spark, whole, phrases)
