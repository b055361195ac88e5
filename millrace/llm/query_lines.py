from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.line_runs import delete_repeated_runs
from millrace.llm.queries import query


@query("op10_line_runs")
def op10_line_runs(t) -> DataFrame:
    """What is left of every document once later copies of repeated line runs are deleted."""
    left = delete_repeated_runs(t.documents)
    return left.select("doc_id", "n_deleted_lines", F.octet_length("text").cast("long").alias("left_bytes"), F.md5("text").alias("left_md5"))
