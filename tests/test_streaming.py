import datetime
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.streaming import counts


def text_folder(tmp_path, files):
    for i, lines in enumerate(files):
        (tmp_path / f"f{i}.log").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def line(status, at="07/Feb/2021:13:14:15 +0000"):
    return f'1.2.3.4 - - [{at}] "GET /x HTTP/1.1" {status} 7'


def test_running_count_over_several_batches(spark, tmp_path):
    folder = text_folder(tmp_path, [[line(200), line(404)], [line(200)], ["garbage"]])
    stream = counts.status_counts(counts.watch_text(spark, folder, files_per_batch=1))
    assert rows(counts.drain_complete(stream, "t")) == [(None, 1), (200, 2), (404, 1)]


BASE = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


def events(spark, tmp_path, files, per_batch=None):
    """A stream of (ts, text) rows, one parquet file per list, in the order given."""
    folder = tmp_path / "events"
    for i, stamps in enumerate(files):
        data = [(BASE + datetime.timedelta(seconds=s), word) for s, word in stamps]
        spark.createDataFrame(data, "ts timestamp, text string").coalesce(1).write.mode("append").parquet(str(folder))
        for new in folder.glob("part-*.parquet"):
            if not new.name.startswith("part-x"):
                new.rename(folder / f"part-x{i}.parquet")
                os.utime(folder / f"part-x{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    reader = spark.readStream.schema("ts timestamp, text string")
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(str(folder))


def start():
    return F.unix_timestamp("window_start") - int(BASE.timestamp())


def test_one_event_counts_in_three_sliding_windows(spark, tmp_path):
    stream = events(spark, tmp_path, [[(35, "a")]])
    windows = counts.drain_windows(stream, "ts", F.col("text"), "30 seconds", "10 seconds")
    assert rows(windows.select(start(), "n")) == [(10, 1), (20, 1), (30, 1)]


@pytest.mark.parametrize("per_batch", [1, None])
def test_late_and_open_windows_are_not_lost(spark, tmp_path, per_batch):
    hour = 3600
    files = [[(10, "a"), (20, "a")], [(hour + 5, "a")], [(5 * hour, "a"), (5 * hour + 1, "a")], [(30, "a")], [(9 * hour, "a")]]
    windows = counts.drain_windows(events(spark, tmp_path, files, per_batch), "ts", F.col("text"), "1 hour")
    assert rows(windows.select(start(), "n")) == [(0, 3), (hour, 1), (5 * hour, 2), (9 * hour, 1)]


def test_windows_need_not_be_a_multiple_of_the_slide(spark, tmp_path):
    windows = counts.drain_windows(events(spark, tmp_path, [[(24, "a")]]), "ts", F.col("text"), "25 seconds", "10 seconds")
    assert rows(windows.select(start(), "n")) == [(0, 1), (10, 1), (20, 1)]


def test_an_empty_folder_gives_no_windows(spark, tmp_path):
    windows = counts.drain_windows(events(spark, tmp_path, [[]]), "ts", F.col("text"), "1 hour")
    assert windows.count() == 0


def test_tag_windows_match_direct_counts(spark, tmp_path):
    stamps = [(t, f"see #t{t % 3} and #all x") for t in range(0, 600, 7)] + [(5000, "end")]
    stream = events(spark, tmp_path, [stamps])
    windows = counts.drain_windows(counts.tagged(stream, "ts", "text"), "ts", F.col("tag"), "300 seconds", "20 seconds")
    got = {(r[0], r[1]): r[2] for r in windows.select(start(), "key", "n").collect()}
    expect = {}
    for t, text in stamps[:-1]:
        for tag in [w for w in text.split() if w.startswith("#")]:
            for first in range(t // 20 * 20 - 280, t // 20 * 20 + 1, 20):
                expect[first, tag] = expect.get((first, tag), 0) + 1
    assert got == expect
