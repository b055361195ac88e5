from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.queries import query
from millrace.llm.quote_threads import reply_order


@query("op7_quote_threads")
def op7_quote_threads(t) -> DataFrame:
    """Every message with what it replies to, its thread and its place there, and its text without quotations."""
    ordered = reply_order(t.conversations, keep=["conv_id", "turn", "role"])
    return ordered.select("conv_id", "turn", "role", "n_quotes", "reply_to_conv", "reply_to_turn", "thread_conv", "thread_turn", "depth", "position", F.md5("own_text").alias("own_md5"))
