"""Streaming counts, drained with the batch result as the check."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.logs import log_fields, log_time
from millrace.operators.ranking import rank_within, top_per_key
from millrace.plans import derived
from millrace.plans.catalog import query
from millrace.session import load
from millrace.storage import scratch_path
from millrace.streaming import counts, windows


@query("stm_running_count", f"WITH {derived.LOG_FIELDS} SELECT CASE WHEN bad THEN NULL ELSE status END AS status, count(*) AS n FROM logs GROUP BY 1")
def _(t):
    lines = counts.watch_text(t.spark, derived.log_folder(t))
    return counts.drain_complete(counts.status_counts(lines), "running_count")


@query(
    "stm_sliding_topk",
    f"""WITH {derived.LOG_FIELDS}, good AS (SELECT CAST(epoch(seen_at) AS BIGINT) AS s, endpoint FROM logs WHERE NOT bad),
    spread AS (SELECT s // 21600 * 21600 - 21600 * i AS window_start, endpoint FROM good, (SELECT unnest(range(4)) AS i)),
    counted AS (SELECT window_start, window_start + 86400 AS window_end, endpoint AS key, count(*) AS n FROM spread GROUP BY 1, 3)
    SELECT window_start, window_end, key, CAST(n AS BIGINT) AS n, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, key) AS rank FROM counted""",
)
def _(t):
    lines = counts.watch_text(t.spark, derived.log_folder(t))
    parsed = lines.select(*log_fields(F.col("value"))).withColumn("at", log_time(F.col("timestamp"))).filter("at IS NOT NULL")
    found = counts.drain_windows(parsed, "at", F.col("endpoint"), "1 day", "6 hours", "endpoint-windows")
    ranked = rank_within(found, ["window_start"], [F.desc("n"), F.col("key")])
    return ranked.select(F.unix_timestamp("window_start").alias("window_start"), F.unix_timestamp("window_end").alias("window_end"), "key", "n", "rank")


@query(
    "stm_hashtag_window",
    """WITH tags AS (SELECT CAST(epoch_us(ts) // 1000000 AS BIGINT) AS s, '#' || event_type AS tag FROM events
      UNION ALL SELECT CAST(epoch_us(ts) // 1000000 AS BIGINT), '#user' || (user_id % 10) FROM events),
    spread AS (SELECT s // 3600 * 3600 - 3600 * i AS window_start, tag FROM tags, (SELECT unnest(range(6)) AS i)),
    counted AS (SELECT window_start, window_start + 21600 AS window_end, tag, CAST(count(*) AS BIGINT) AS n FROM spread GROUP BY 1, 3)
    SELECT window_start, window_end, tag, n FROM (
      SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, tag) AS rank FROM counted) WHERE rank <= 10""",
)
def _(t):
    posts = _posts(counts.watch_parquet(t.spark, t.path("events"), t.events.schema))
    found = counts.drain_windows(counts.tagged(posts, "ts", "text"), "ts", F.col("tag"), "6 hours", "1 hour", "tag-windows")
    top = top_per_key(found, ["window_start"], [F.desc("n"), F.col("key")], 10)
    return top.select(F.unix_timestamp("window_start").alias("window_start"), F.unix_timestamp("window_end").alias("window_end"), F.col("key").alias("tag"), "n")


def _posts(rows):
    """Posts of (ts, text) with two tags each, from events."""
    return rows.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat_ws(" ", F.lit("saw"), F.concat(F.lit("#"), "event_type"), F.concat(F.lit("#user"), (F.col("user_id") % 10).cast("string")), F.lit("again")).alias("text"),
    )


# Rows arrive in three parts by event number; a part's watermark trails the newest event of the parts before by two days.
ARRIVALS = """tags AS (SELECT event_id % 3 AS arrival, epoch_ms(ts) AS ms, CAST(epoch_ms(ts) // 3600000 * 3600 AS BIGINT) AS step, '#' || event_type AS tag FROM events
      UNION ALL SELECT event_id % 3, epoch_ms(ts), CAST(epoch_ms(ts) // 3600000 * 3600 AS BIGINT), '#user' || (user_id % 10) FROM events),
    marks AS (SELECT arrival, max(max(ms)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 172800000 AS mark FROM tags GROUP BY arrival),
    judged AS (SELECT step, tag, mark IS NOT NULL AND (step + 3600) * 1000 <= mark AS late FROM tags JOIN marks USING (arrival)),
    spread AS (SELECT step + 3600 * i AS window_end, tag FROM judged, (SELECT unnest(range(1, 7)) AS i) WHERE NOT late),
    closed AS (SELECT window_end, tag, CAST(count(*) AS BIGINT) AS n FROM spread WHERE window_end * 1000 <= (SELECT max(ms) - 172800000 FROM tags) GROUP BY ALL)"""


def _arrived(t):
    """The state folder after three arrivals, each drained by a stream that starts anew from the checkpoint."""
    source, folder = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "incremental")
    events = load(t.spark, t.sf_dir, "events")
    for arrival in range(3):
        _posts(events.filter(F.col("event_id") % 3 == arrival)).write.mode("append").parquet(source)
        posts = t.spark.readStream.schema("ts timestamp, text string").parquet(source)
        tagged = counts.tagged(posts, "ts", "text")
        windows.drain_incremental(windows.incremental_windows(tagged, "ts", F.col("tag"), "6 hours", "1 hour", "2 days"), folder)
    return windows.read_incremental(t.spark, folder)


@query(
    "stm_hashtag_incremental",
    f"""WITH {ARRIVALS} SELECT window_end, tag, n, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY n DESC, tag) AS rank FROM closed) WHERE rank <= 10""",
)
def _(t):
    """The ten most used tags of every complete window, kept up to date step by step."""
    top = top_per_key(_arrived(t)[0], ["window_end"], [F.desc("n"), F.col("key")], 10)
    return top.select(F.unix_timestamp("window_end").alias("window_end"), F.col("key").alias("tag"), "n", F.col("rank").cast("long").alias("rank"))


@query("stm_hashtag_late", f"WITH {ARRIVALS} SELECT step, tag, CAST(count(*) AS BIGINT) AS n FROM judged WHERE late GROUP BY ALL")
def _(t):
    """Rows that came after the watermark, counted per step and tag."""
    return _arrived(t)[1].select(F.unix_timestamp("step").alias("step"), F.col("key").alias("tag"), "n")
