from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.cover_tree import top_products
from millrace.llm.queries import query


@query(
    "op8_cover_tree",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
        WHERE q.vec_id % 50 = 0
    ),
    r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op8_cover_tree(t) -> DataFrame:
    """The five best rows by inner product for every vector whose id is divisible by 50."""
    return top_products(t.embeddings, F.col("_vec") % 50 == 0)
