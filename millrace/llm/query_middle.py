from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.fill_middle import restored, transform
from millrace.llm.queries import query

SQL = r"""WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS d,
    CASE WHEN coalesce(text, '') = '' THEN CAST([] AS VARCHAR[]) ELSE regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') END AS u
  FROM documents),
drawn AS (SELECT *, len(u) AS n, CAST('0x' || substr(d, 1, 8) AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || substr(d, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (SELECT doc_id, text, n, form, array_to_string(u[1:least(a, b)], '') AS p,
    array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM parts"""


@query("op11_fill_middle", SQL)
def op11_fill_middle(t) -> DataFrame:
    """Every document cut at two boundaries, its output, and the text rebuilt from that."""
    cut = transform(t.documents, keep=["doc_id"])
    digest = [F.sha2(c, 256) for c in (F.col("output"), restored(F.col("output"), F.col("form")))]
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest[0].alias("output_sha256"), digest[1].alias("restored_sha256"))
