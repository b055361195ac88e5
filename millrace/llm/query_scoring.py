from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.llm.class_model import score
from millrace.llm.queries import query


@query("op12_class_model")
def op12_class_model(t) -> DataFrame:
    """Log probabilities of all documents under a class bigram model of nine tenths of them."""
    return score(t.documents)
