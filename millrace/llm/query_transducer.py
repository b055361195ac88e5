from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame

from millrace.llm.bpe_transducer import round_trip
from millrace.llm.queries import query

RANKS = "byte_bpe_multi_50k.tiktoken"


@query("op9_bpe_transducer")
def op9_bpe_transducer(t) -> DataFrame:
    """Every whole document encoded by the transducer and decoded again."""
    return round_trip(t.documents, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=["doc_id"])
