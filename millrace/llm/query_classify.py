from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.llm.quality_cnn import held_out, score, train
from millrace.llm.queries import query


@query("op1_quality_cnn")
def op1_quality_cnn(t) -> DataFrame:
    """Every whole document's quality score; labels of held-out rows are never learned from."""
    net = train(t.documents, t.labels)
    scored = score(t.documents, net, keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
