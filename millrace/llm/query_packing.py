from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame

from millrace.llm.queries import query
from millrace.llm.slack_packing import cut_pieces, pack

TOKENIZER = "word_bpe_49k.json"


@query("op3_slack_packing")
def op3_slack_packing(t) -> DataFrame:
    """Every document's tokens, packed into sequences of at most 2048."""
    pieces = cut_pieces(t.documents, public_tokenizers.path(TOKENIZER), keep=["doc_id"], with_ids=False, batch_bytes=12 << 20)
    return pack(pieces)
