"""Incremental windows: every advance against recounting, streams against brute force over restarts, late rows, state that goes."""

import os
import random
import subprocess
import sys
from collections import Counter
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import ROOT, rows
from millrace.streaming.windows import _combined, advance, drain_incremental, incremental_windows, read_incremental


@pytest.mark.parametrize("length, slide, step", [(6, 2, 2), (10, 4, 2), (4, 4, 4), (3, 6, 3)])
def test_advance_is_a_recount(length, slide, step):
    rng = random.Random(length)
    steps, total, next_end, kept, out, late = {}, 0, None, Counter(), [], Counter()
    watermark = 0
    for _ in range(60):
        new = [(rng.randint(0, 40) * step + watermark // 1000 // step * step - 5 * step, rng.randint(1, 3)) for _ in range(rng.choice([0, 0, 1, 4]))]
        for start, n in new:
            (late if (start + step) * 1000 <= watermark else kept)[start] += n
        found, steps, total, next_end = advance(steps, total, next_end, new, watermark, length, slide, step)
        out += found
        assert len(steps) <= 48 + length // step and (next_end is None) == (not steps)
        watermark += rng.choice([0, 500, 3000, 40_000])
    found, steps, total, next_end = advance(steps, total, next_end, [], 10**9, length, slide, step)
    out += found
    assert not steps and next_end is None and total == 0
    windows = [(at, n) for kind, at, n in out if kind == "window"]
    ends = range(-100 * slide, 10**4 * slide, slide)
    expect = {e: sum(n for s, n in kept.items() if e - length <= s < e) for e in ends if any(e - length <= s < e for s in kept)}
    assert len(windows) == len(dict(windows)) and dict(windows) == expect
    seen = Counter()
    for kind, at, n in out:
        if kind == "late":
            seen[at] += n
    assert seen == late


START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def arrivals(seed, hot):
    """Batches of (seconds, key); times move on, some rows are far behind, and one key may hold most rows."""
    rng = random.Random(seed)
    return [
        [(b * 300 + rng.randint(-900 if rng.random() < 0.3 else 0, 300), "hot" if rng.random() < hot else rng.choice(["a", "b", None])) for _ in range(rng.choice([40, 400]))]
        for b in range(4)
    ]


def brute(batches, length, slide, step, delay):
    mark, kept, late, newest = None, Counter(), Counter(), 0
    for batch in batches:
        for s, key in batch:
            start = s // step * step
            if mark is not None and start + step <= mark:
                late[start, key] += 1
            else:
                kept[start, key] += 1
        newest = max(newest, *[s for s, _ in batch])
        mark = newest - delay
    windows = Counter()
    for (start, key), n in kept.items():
        end = start // slide * slide + slide
        while end <= start + length:
            if end >= start + step and end <= mark:
                windows[end, key] += n
            end += slide
    return windows, late


@pytest.mark.parametrize("hot, most_held", [(0.1, 100_000), (0.9, 3)])
def test_restarted_stream_matches_brute_force(spark, tmp_path, hot, most_held):
    length, slide, delay = 600, 120, 60
    batches = arrivals(7, hot)
    source, folder = f"{tmp_path}/source", f"{tmp_path}/out"
    sizes = []
    for batch in batches:
        data = [(START + timedelta(seconds=s), k) for s, k in batch] + [(None, "untimed")]
        spark.createDataFrame(data, "ts timestamp, key string").repartition(3).write.mode("append").parquet(source)
        stream = spark.readStream.schema("ts timestamp, key string").parquet(source)
        windows = incremental_windows(stream, "ts", F.col("key"), f"{length} seconds", f"{slide} seconds", f"{delay} seconds", most_held)
        progress = drain_incremental(windows, folder)
        sizes.append(progress[-1]["stateOperators"][0]["numRowsTotal"])
        drain_incremental(windows, folder)  # nothing new: nothing changes
    assert max(sizes) <= 4
    found, late = read_incremental(spark, folder)
    base = int(START.timestamp())
    expect, expect_late = brute(batches, length, slide, 120, delay)
    assert rows(found.select(F.unix_timestamp("window_end") - base, "key", "n")) == sorted(((e, k, n) for (e, k), n in expect.items()), key=lambda r: tuple((v is not None, v) for v in r))
    assert rows(late.select(F.unix_timestamp("step") - base, "key", "n")) == sorted(((s, k, n) for (s, k), n in expect_late.items()), key=lambda r: tuple((v is not None, v) for v in r))
    assert sum(expect_late.values()) > 5 and len(expect) > 5


def test_state_goes_with_the_last_step(spark, tmp_path):
    source, folder = f"{tmp_path}/source", f"{tmp_path}/out"
    for n, (seconds, key) in enumerate([(0, "a"), (10_000, "b"), (20_000, "c")]):
        spark.createDataFrame([(START + timedelta(seconds=seconds), key)], "ts timestamp, key string").write.mode("append").parquet(source)
        stream = spark.readStream.schema("ts timestamp, key string").parquet(source)
        progress = drain_incremental(incremental_windows(stream, "ts", F.col("key"), "600 seconds", "120 seconds"), folder)
        assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 1
    assert read_incremental(spark, folder)[0].groupBy("key").count().filter("count = 5").count() == 2


def test_counts_are_combined_over_many_batches():
    """Sums meet further batches, whose columns Spark marks as holding no null."""
    now = datetime(2024, 1, 1, tzinfo=timezone.utc)
    schema = pa.schema([pa.field("step", pa.int64()), pa.field("key", pa.string()), pa.field("n", pa.int64(), nullable=False), pa.field("seen", pa.timestamp("us", "UTC"))])
    batches = [pa.RecordBatch.from_pydict({"step": [0, 0, 3600], "key": ["a", "b", None], "n": [1, 1, 1], "seen": [now] * 3}, schema) for _ in range(40)]
    for most_held in (3, 8, 10**5):
        found = Counter()
        for part in _combined(iter(batches), most_held):
            for row in part.to_pylist():
                found[row["step"], row["key"]] += row["n"]
        assert found == {(0, "a"): 40, (0, "b"): 40, (3600, None): 40, (None, None): 0}


def test_workers_need_no_package(tmp_path):
    """Workers that start elsewhere, without the package on their path."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import functions as F
from millrace.session import build_session
from millrace.streaming.windows import drain_incremental, incremental_windows, read_incremental
spark = build_session("away", "local[2]", 2, spark__ui__enabled="false", spark__driver__host="127.0.0.1")
spark.range(90).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.lit("a").alias("tag")).write.parquet("in")
stream = spark.readStream.schema("ts timestamp, tag string").parquet("in")
drain_incremental(incremental_windows(stream, "ts", F.col("tag"), "1 hour"), "out")
print("windows", [r["n"] for r in read_incremental(spark, "out")[0].collect()])
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=120)
    assert "windows [60]" in done.stdout, done.stderr[-2000:]
