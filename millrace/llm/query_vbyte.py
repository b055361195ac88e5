from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame

from millrace.llm.queries import query
from millrace.llm.vbyte_files import read_ids, write_ids
from millrace.storage import scratch_path

TOKENIZER = "byte_bpe_50k.json"


@query("op4_vbyte_ids")
def op4_vbyte_ids(t) -> DataFrame:
    """Every document's token ids, written to files in order of doc_id and read back from them."""
    folder = scratch_path(t.spark, "token_ids")
    shards = write_ids(t.documents, folder, public_tokenizers.path(TOKENIZER))
    return read_ids(t.spark, folder, shards, with_ids=False)
