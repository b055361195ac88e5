from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import divergence_rules as rules
from millrace.llm.queries import query

# The classes as regular expressions; what is in none of them is "other".
_PATTERNS = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "space": r"[\x20\x09-\x0D]", "point": r"[.,;:!?''\"()\-]", "symbol": "[#*$%&|<>]", "beyond_ascii": r"[^\x00-\x7F]"}
_COMMON = ", ".join("('{}')".format(w.decode()) for w in rules.vocabulary())
_LANGS = ", ".join(f"'{k}'" for k in rules.COMMON_WORDS)


def _count(pattern: str) -> str:
    return f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"


def _divergence(cells: str, of_doc: str) -> str:
    """Jensen-Shannon distance of each document to each language; ``cells``: doc_id, bin, n; all bins listed."""
    return f"""(SELECT c.doc_id, r.lang,
        CASE WHEN any_value(c.total) = 0 THEN 1.0::DOUBLE ELSE sqrt(greatest(0, sum(
          CASE WHEN c.n > 0 THEN c.n / c.total * log2(c.n / c.total / ((c.n / c.total + r.q) / 2)) ELSE 0 END
          + CASE WHEN r.q > 0 THEN r.q * log2(r.q / (((CASE WHEN c.total > 0 THEN c.n / c.total ELSE 0 END) + r.q) / 2)) ELSE 0 END) / 2)) END AS {of_doc}
      FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id) AS total FROM {cells}) c JOIN ref_{cells} r USING (bin) GROUP BY 1, 2)"""


def _reference(cells: str) -> str:
    return f"""ref_{cells} AS (SELECT lang, bin, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q FROM {cells} JOIN base USING (doc_id)
      WHERE lang IN (SELECT lang FROM langs) GROUP BY lang, bin)"""


_SQL = f"""
WITH base AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
langs AS (SELECT lang FROM base WHERE lang IN ({_LANGS}) GROUP BY lang HAVING sum(len(w)) >= {rules.MIN_REFERENCE_WORDS}),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM base),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS found FROM (
  SELECT doc_id, i, word AS a, lead(word) OVER d AS b, lead(word, 2) OVER d AS c FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)) WHERE c IS NOT NULL),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE found > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM base),
classes AS (SELECT doc_id, unnest([{", ".join(f"'{k}'" for k in _PATTERNS)}, 'other']) AS bin,
  unnest([{", ".join(_count(p) for p in _PATTERNS.values())}, length(t) - ({" + ".join(f"({_count(p)})" for p in _PATTERNS.values())})]) AS n FROM base),
common AS (SELECT * FROM (VALUES {_COMMON}) AS v(word)),
found AS (SELECT doc_id, coalesce(c.word, '') AS bin, count(*) AS n FROM words LEFT JOIN common c ON words.word = c.word GROUP BY 1, 2),
bins AS (SELECT doc_id, b.bin, coalesce(n, 0) AS n FROM base CROSS JOIN (SELECT word AS bin FROM common UNION ALL SELECT '') b LEFT JOIN found USING (doc_id, bin)),
{_reference("classes")}, {_reference("bins")},
near AS (SELECT doc_id, lang, dc, dw FROM {_divergence("classes", "dc")} x JOIN {_divergence("bins", "dw")} y USING (doc_id, lang)),
counts AS (SELECT doc_id, length(t) AS n_chars, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST({_count("[#*$%&|<>]")} AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM base JOIN lines USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
judged AS (SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
verdict AS (SELECT doc_id, min(dc) AS class_distance, min(dw) AS word_distance,
  bool_or((n_chars < {rules.MIN_CLASS_CHARS} OR dc <= {rules.MAX_CLASS_DISTANCE}) AND (n_words < {rules.MIN_WORD_COUNT} OR dw <= {rules.MAX_WORD_DISTANCE})) AS good
  FROM near JOIN judged USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(good, true) AS kept,
  round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance FROM judged LEFT JOIN verdict USING (doc_id)
"""


@query("op6_divergence_rules", _SQL)
def op6_divergence_rules(t) -> DataFrame:
    """Base counts and verdict of every document against references summed over all documents."""
    judged = rules.judge(t.documents, keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"),
    )
