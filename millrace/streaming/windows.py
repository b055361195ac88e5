"""Sliding windows kept up to date: a step that enters is added, a step that leaves is subtracted.

A key's state is one row in the state store: the counts of its open steps, their running total and
the end of the next window. It holds at most as many steps as a window and the delay span, and is
removed when the last step has left. An event-time timeout wakes a key for its next window also
when nothing new comes for it. Rows are first counted per step and key in their own tasks, so
a key with most of the rows reaches its state as a few partial counts.

The watermark trails the newest event by ``delay``. A window comes out once, when the watermark
reaches its end. A row is late if its step has ended by the watermark of its batch: no window that
holds it is complete without it. Late rows are counted in a table of their own, so on-time and late
rows together are all rows; rows without a time take no part. Times are from 1970 on. A null key is a key.

``counts.drain_windows`` is the form without a watermark: nothing is late there, and open windows show.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.storage import ship_package
from millrace.streaming.counts import step_of

#: kind is "window" (``at``: its end) or "late" (``at``: start of the step).
OUTPUT = "kind string, at timestamp, key string, n long"
STATE = "steps array<long>, counts array<long>, total long, next_end long"
PARTIAL = pa.schema([("step", pa.int64()), ("key", pa.string()), ("n", pa.int64()), ("seen", pa.timestamp("us", "UTC"))])
COUNTS = pa.schema([PARTIAL.field(name) for name in ("step", "key", "n")])
#: Partial counts that a task holds before it passes them on.
MOST_HELD = 100_000


def _combined(batches: Iterator[pa.RecordBatch], most_held: int) -> Iterator[pa.RecordBatch]:
    """One row per step and key of a task's rows, and one that holds its newest time alone."""

    def summed(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by(["step", "key"]).aggregate([("n", "sum")]).rename_columns(["step", "key", "n"]).cast(COUNTS)

    def passed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        return pa.Table.from_arrays([*table.columns, pa.nulls(table.num_rows, PARTIAL.field("seen").type)], schema=PARTIAL).to_batches()

    held: list[pa.Table] = []
    newest = None
    for batch in batches:
        last = pc.max(batch.column("seen"))
        newest = last if newest is None or (last.is_valid and last.as_py() > newest.as_py()) else newest
        # Spark marks columns that hold no null, sums are not marked: one schema for both.
        held.append(pa.Table.from_batches([batch]).select(["step", "key", "n"]).cast(COUNTS))
        if sum(t.num_rows for t in held) >= most_held:
            held = [summed(held)]
            if held[0].num_rows >= most_held // 2:
                yield from passed(held[0])
                held = []
    if held:
        yield from passed(summed(held))
    if newest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((None, None, 0, newest.as_py()), PARTIAL)], schema=PARTIAL)


def advance(
    steps: dict[int, int], total: int, next_end: int | None, new: list[tuple[int, int]], watermark: int, length: int, slide: int, step: int
) -> tuple[list[tuple[str, int, int]], dict[int, int], int, int | None]:
    """Rows (kind, at, n) that come out, and the state after them; all times in seconds but ``watermark`` in milliseconds.

    ``total`` is the count of the steps in the window that ends at ``next_end``.
    """
    out = []
    for start, n in new:
        if (start + step) * 1000 <= watermark:
            out.append(("late", start, n))
            continue
        steps[start] = steps.get(start, 0) + n
        first_end = (start + step - 1) // slide * slide + slide
        if next_end is None or first_end < next_end:
            # A key without a window to come, or with one that is not open yet, starts at the earliest step.
            next_end = first_end
            total = sum(c for s, c in steps.items() if next_end - length <= s < next_end)
        elif next_end - length <= start < next_end:
            total += n
    while next_end is not None and next_end * 1000 <= watermark:
        if total:
            out.append(("window", next_end, total))
        after = next_end + slide
        for start in sorted(steps):
            if start < after - length:
                if next_end - length <= start < next_end:
                    total -= steps[start]
                del steps[start]
            elif next_end <= start < after:
                total += steps[start]
        next_end = after if steps else None
        if next_end is not None and not total:
            next_end = max(after, (min(steps) + step - 1) // slide * slide + slide)
            total = sum(c for s, c in steps.items() if next_end - length <= s < next_end)
    return out, steps, total, next_end


def _slide_windows(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState, length: int, slide: int, step: int) -> Iterator[pd.DataFrame]:
    steps, total, next_end = {}, 0, None
    if state.exists:
        starts, counts, total, next_end = state.get
        steps = dict(zip(starts, counts))
    # Rows without a step hold the time alone.
    new = [] if state.hasTimedOut else [(int(s), int(n)) for part in parts for s, n in zip(part["step"], part["n"]) if not pd.isna(s)]
    out, steps, total, next_end = advance(steps, total, next_end, new, state.getCurrentWatermarkMs(), length, slide, step)
    if steps:
        order = sorted(steps)
        state.update((order, [steps[s] for s in order], total, next_end))
        state.setTimeoutTimestamp(next_end * 1000)
    elif state.exists:
        state.remove()
    if out:
        kinds, at, n = zip(*out)
        yield pd.DataFrame({"kind": kinds, "at": pd.to_datetime(at, unit="s"), "key": key[0], "n": n})


def incremental_windows(stream: DataFrame, ts: str, key: Column, length: str, slide: str | None = None, delay: str = "0 seconds", most_held: int = MOST_HELD) -> DataFrame:
    """The unbounded table of complete windows per key, and of late counts, as ``OUTPUT``."""
    spark = stream.sparkSession
    ship_package(spark)
    slide = slide or length
    step = step_of(spark, length, slide)
    seconds = spark.sql(f"SELECT CAST(TIMESTAMP'1970-01-01 00:00:00' + INTERVAL {length} AS LONG), CAST(TIMESTAMP'1970-01-01 00:00:00' + INTERVAL {slide} AS LONG)").first()
    timed = stream.filter(F.col(ts).isNotNull())
    steps = timed.select(F.unix_timestamp(F.window(ts, step)["start"]).alias("step"), key.cast("string").alias("key"), F.lit(1).cast("long").alias("n"), F.col(ts).alias("seen"))
    # Counts have no event time of their own, so that Spark does not drop late ones; each task's newest time moves the watermark.
    partials = steps.mapInArrow(partial(_combined, most_held=most_held), "step long, key string, n long, seen timestamp").withWatermark("seen", delay)
    work = partial(_slide_windows, length=seconds[0], slide=seconds[1], step=int(step.split()[0]))
    return partials.groupBy("key").applyInPandasWithState(work, OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def drain_incremental(windows: DataFrame, folder: str) -> list[dict]:
    """Process what is there and append it to the table in ``folder``; its own state is there too.

    Called again with the same folder it goes on from its checkpoint. The progress of its batches comes back.
    """
    query = (
        windows.writeStream.format("parquet").partitionBy("kind").outputMode("append")
        .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/table")
    )
    query.awaitTermination()
    return query.recentProgress


def read_incremental(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(window_end, key, n) of complete windows, and (step, key, n) of late rows."""
    table = spark.read.schema(OUTPUT).parquet(f"{folder}/table")
    windows = table.filter("kind = 'window'").select(F.col("at").alias("window_end"), "key", "n")
    late = table.filter("kind = 'late'").groupBy(F.col("at").alias("step"), "key").agg(F.sum("n").alias("n"))
    return windows, late
