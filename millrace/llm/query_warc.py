from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.llm.queries import query
from millrace.llm.warc import read_archives, write_archives
from millrace.storage import scratch_path


@query(
    "op5_warc",
    """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS m FROM p)
    SELECT page_id, n AS payload_bytes, d AS payload_digest,
           CASE WHEN n >= 1000 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND page_id <> m THEN m END AS refers_to
    FROM g
    """,
)
def op5_warc(t) -> DataFrame:
    """Every page as a record of Zstandard WARC archives, read back from them."""
    files = write_archives(t.pages, scratch_path(t.spark, "warc"))
    return read_archives(t.spark, files, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
