"""Chat formatting: quotations linked to the messages they come from, conversations in reply order.

Lines that begin with ``>`` are quotations, nested by the number of marks. Neighbouring lines of one
level are a passage; passages and their single lines are normalised (white space, case) and
hashed, and so are the paragraphs, lines and whole of what a message says itself. A quotation
belongs to the first message that said it: in the same conversation if one did so before, else in any
conversation before this message. The shallowest linked passage names the message replied to.

A message's thread is found by doubling its steps towards the first message. Conversations come
back in reply order: by the conversation and turn a thread begins with, then by depth, then by
conversation and turn; ``position`` numbers each conversation from 1. ``own_text`` is the text
without quotations and the lines that introduce them.

The first message of a passage is a minimum per hash, so a passage that a third of all messages
quote is one row; joins meet stored tables, whose hot keys Spark splits.

Defined results: a null text stays null and quotes nothing; a text without quotations stays as it
is. Messages without conversation or turn are neither linked nor linked to, and are threads of
their own; those without a conversation share one. Rows of equal conversation and turn are one message in several
rows: linked alike, ordered by role and text. Results replace input columns of their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.support import extended, kept_columns, ship
from millrace.operators.ranking import rank_within
from millrace.storage import materialize

MARKS = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
INTRODUCTION = re.compile(r"^On\b.{1,300}\bwrote:\s*$")
RESULTS = ("own_text", "n_quotes", "reply_to_conv", "reply_to_turn", "thread_conv", "thread_turn", "depth", "position")
BLOCK, LINE = 0, 1


def levels(text: str) -> list[tuple[int, str]]:
    """(number of quotation marks, rest) of each line."""
    out = []
    for line in text.split("\n"):
        found = MARKS.match(line)
        out.append((found[1].count(">"), line[found.end() :]) if found else (0, line))
    return out


def passages(lines: list[tuple[int, str]]) -> list[tuple[int, list[str]]]:
    """Neighbouring lines of one level, parted at blank lines too; blank lines belong to none."""
    out: list[tuple[int, list[str]]] = []
    open_level = None
    for level, line in lines:
        if not line.strip():
            open_level = None
        elif level == open_level:
            out[-1][1].append(line)
        else:
            out.append((level, [line]))
            open_level = level
    return out


def passage_hash(lines: list[str]) -> int:
    """64 bits of the words of the lines, lower-cased, with single spaces; signed."""
    value = xxhash.xxh3_64_intdigest(" ".join(" ".join(lines).lower().split()).encode())
    return value - (1 << 64) if value >> 63 else value


def read_message(text: str | None) -> tuple[str | None, list[tuple[int, int, int]], list[int]]:
    """Own text, quotations (level, whole passage or line, hash), and hashes of what the message says itself."""
    if text is None:
        return None, [], []
    lines = levels(text)
    quotes, own = [], set()
    for level, held in passages(lines):
        if level:
            quotes.append((level, BLOCK, passage_hash(held)))
            quotes += [(level, LINE, passage_hash([x])) for x in held if len(held) > 1]
        else:
            own.add(passage_hash(held))
            own.update(passage_hash([x]) for x in held)
    said = [x for level, x in lines if not level and x.strip()]
    if said:
        own.add(passage_hash(said))
    if not quotes:
        return text, [], sorted(own)
    kept = []
    for i, (level, line) in enumerate(lines):
        introduces = INTRODUCTION.match(line) and any(lv for lv, rest in lines[i + 1 : i + 3] if rest.strip())
        if not level and not introduces:
            kept.append(line)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(kept)).strip("\n"), quotes, sorted(own)


def _read(batches: Iterator[pa.RecordBatch], text_col: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    quote = pa.list_(pa.struct([("level", pa.int32()), ("kind", pa.int32()), ("hash", pa.int64())]))
    for batch in batches:
        found = [read_message(t) for t in batch.column(text_col).to_pylist()]
        quotes = [[{"level": a, "kind": b, "hash": c} for a, b, c in f[1]] for f in found]
        columns = [pa.array([f[0] for f in found], pa.string()), pa.array([sum(q["kind"] == BLOCK for q in x) for x in quotes], pa.int64()), pa.array(quotes, quote), pa.array([f[2] for f in found], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *columns], names=[*keep, "own_text", "n_quotes", "_quotes", "_own"])


def _links(messages: DataFrame) -> DataFrame:
    """``_c``, ``_t`` of each message with a linked quotation, and ``_pc``, ``_pt`` of the message it replies to."""
    known = messages.filter("_c is not null and _t is not null")
    quotes = materialize(known.select("_c", "_t", F.explode("_quotes").alias("q")).select("_c", "_t", "q.level", "q.kind", "q.hash").distinct(), "quotes")
    # Only passages that someone quotes are looked for.
    asked = materialize(quotes.select(F.col("hash").alias("_asked")).distinct(), "asked")
    said = materialize(known.select("_c", "_t", F.explode("_own").alias("hash")), "said")
    said = said.join(asked, F.col("hash") == F.col("_asked"), "left_semi")
    in_conv = materialize(said.groupBy(F.col("hash").alias("_h"), F.col("_c").alias("_hc")).agg(F.min("_t").alias("_first")), "first_in_conversation")
    overall = materialize(in_conv.groupBy(F.col("_h").alias("_g")).agg(F.min(F.struct(F.col("_hc").alias("c"), F.col("_first").alias("t"))).alias("_any")), "first_anywhere")
    near = quotes.join(in_conv, (F.col("hash") == F.col("_h")) & (F.col("_c") == F.col("_hc")) & (F.col("_first") < F.col("_t")), "left").drop("_h", "_hc")
    near = materialize(near, "quotes_near")
    far = near.join(overall, F.col("hash") == F.col("_g"), "left")
    here = F.col("_first").isNotNull()
    before = F.struct(F.col("_any.c").alias("c"), F.col("_any.t").alias("t")) < F.struct(F.col("_c").alias("c"), F.col("_t").alias("t"))
    parent = F.when(here, F.struct(F.col("_c").alias("c"), F.col("_first").alias("t"))).when(before, F.col("_any"))
    linked = far.withColumn("_parent", parent).filter("_parent is not null")
    best = linked.groupBy("_c", "_t").agg(F.min(F.struct("level", "kind", (~here).alias("elsewhere"), "_parent")).alias("b"))
    return best.select("_c", "_t", F.col("b._parent.c").alias("_pc"), F.col("b._parent.t").alias("_pt"))


def _threads(links: DataFrame) -> DataFrame:
    """Each linked message with the first message of its thread and its depth below it; a reply is always later."""
    now = materialize(links.select("_c", "_t", F.col("_pc").alias("_rc"), F.col("_pt").alias("_rt"), F.lit(1).cast("long").alias("_depth")), "steps")
    while True:
        above = now.select(F.col("_c").alias("_ac"), F.col("_t").alias("_at"), F.col("_rc").alias("_nc"), F.col("_rt").alias("_nt"), F.col("_depth").alias("_nd"))
        met = now.join(above, (F.col("_rc") == F.col("_ac")) & (F.col("_rt") == F.col("_at")), "left")
        moved = met.select("_c", "_t", F.coalesce("_nc", "_rc").alias("_rc"), F.coalesce("_nt", "_rt").alias("_rt"), (F.col("_depth") + F.coalesce("_nd", F.lit(0))).alias("_depth"), F.col("_nc").isNotNull().alias("_moved"))
        now = materialize(moved, "steps")
        if not now.filter("_moved").take(1):
            return now.drop("_moved")


def reply_order(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of every message (all when not given) with its own text, links, thread and position."""
    ship(df.sparkSession)
    keep = kept_columns(df, keep, (*RESULTS, "_c", "_t", "_r"))
    keyed = df.select(*[f"`{c}`" for c in kept_columns(df, None, ("_c", "_t", "_r", "_quotes", "_own", "_tie"))], F.col(conv_col).alias("_c"), F.col(turn_col).alias("_t"), F.col(role_col).alias("_r"))
    passed = [*keep, "_c", "_t", "_r"]
    needed = keyed.select(*[f"`{c}`" for c in dict.fromkeys([*passed, text_col])])
    schema = extended(needed.select(*[f"`{c}`" for c in passed]).schema, "own_text string, n_quotes long, _quotes array<struct<level:int,kind:int,hash:long>>, _own array<long>")
    messages = materialize(needed.mapInArrow(partial(_read, text_col=text_col, keep=passed), schema), "messages")
    links = materialize(_links(messages), "links")
    threads = _threads(links)
    replies = materialize(
        links.join(threads, ["_c", "_t"]).select(F.col("_c").alias("_lc"), F.col("_t").alias("_lt"), F.col("_pc").alias("reply_to_conv"), F.col("_pt").alias("reply_to_turn"), "_rc", "_rt", "_depth"), "replies"
    )
    joined = messages.drop("_quotes", "_own").join(replies, (F.col("_c") == F.col("_lc")) & (F.col("_t") == F.col("_lt")), "left")
    linked = F.col("_lc").isNotNull()
    full = joined.withColumns({
        "thread_conv": F.when(linked, F.col("_rc")).otherwise(F.col("_c")), "thread_turn": F.when(linked, F.col("_rt")).otherwise(F.col("_t")),
        "depth": F.coalesce("_depth", F.lit(0)).cast("long"), "_tie": F.xxhash64("_r", "own_text"),
    })
    chosen = full.select(*[f"`{c}`" for c in keep], *[r for r in RESULTS if r != "position"], "_c", "_t", "_r", "_tie")
    order = [F.col("thread_turn"), F.col("depth"), F.col("_c"), F.col("_t"), F.col("_r"), F.col("_tie")]
    ranked = rank_within(chosen, ["thread_conv"], order, "position")
    return ranked.drop("_c", "_t", "_r", "_tie")
