from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.llm.ngram_join import similar_texts
from millrace.llm.queries import query


@query("op2_ngram_join")
def op2_ngram_join(t) -> DataFrame:
    """Class and number of links of every document: five-word n-grams, similarity 0.8 or more."""
    return similar_texts(t.documents)
