"""Streaming counts: running, sliding-window and tag counts; windows lose no row, early or late."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.logs import log_fields
from millrace.functions.strings import tokens
from millrace.storage import scratch_path


def watch_text(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """New text files of a folder as an unbounded table of lines."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def watch_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet files of a folder, or one parquet file, as an unbounded table.

    The path is given as a pattern, because a plain path must be a folder for a stream.
    """
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def status_counts(lines: DataFrame) -> DataFrame:
    """Running count per status code over parsed log lines (at most a thousand codes of state)."""
    return lines.select(*log_fields(F.col("value"))).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def step_of(spark: SparkSession, length: str, slide: str) -> str:
    """The longest step that windows of ``length`` every ``slide`` are made of, in seconds."""
    row = spark.sql(f"SELECT CAST(TIMESTAMP'1970-01-01 00:00:00' + INTERVAL {length} AS LONG), CAST(TIMESTAMP'1970-01-01 00:00:00' + INTERVAL {slide} AS LONG)").first()
    return f"{math.gcd(*row)} seconds"


def windowed(partials: DataFrame, length: str, slide: str) -> DataFrame:
    """Counts per (step, key), summed into every window that holds the step."""
    summed = partials.groupBy(F.window("step", length, slide).alias("w"), "key").agg(F.sum("n").alias("n"))
    return summed.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "key", "n")


def drain_windows(stream: DataFrame, ts: str, key: Column, length: str, slide: str | None = None, label: str = "windows") -> DataFrame:
    """Rows per (event-time window, key) of all that is there, late rows and open windows included.

    Every batch writes its own counts per (step, key) to the shared folder, under its number, so a
    batch that runs again replaces what it wrote. No state is kept, a late row just adds to its
    step, and the result does not depend on how files fall into batches. A row is not multiplied by
    ``length / slide``: only step counts are spread over windows, when they are read.
    """
    spark = stream.sparkSession
    slide = slide or length
    step = step_of(spark, length, slide)
    out = scratch_path(spark, label)

    def counted(rows: DataFrame) -> DataFrame:
        steps = rows.filter(F.col(ts).isNotNull()).groupBy(F.window(ts, step).alias("w"), key.alias("key"))
        return steps.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("step"), "key", "n")

    nothing = counted(spark.createDataFrame([], stream.schema))
    nothing.write.parquet(f"{out}/batch=-1")
    query = (
        stream.writeStream.foreachBatch(lambda rows, number: counted(rows).write.mode("overwrite").parquet(f"{out}/batch={number}"))
        .option("checkpointLocation", scratch_path(spark, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return windowed(spark.read.schema(nothing.schema).parquet(f"{out}/batch=*"), length, slide)


def tagged(df: DataFrame, ts: str, text: str, mark: str = "#") -> DataFrame:
    """``ts`` and ``tag`` of every word that starts with ``mark``."""
    return df.select(ts, F.explode(tokens(F.col(text))).alias("tag")).filter(F.col("tag").startswith(mark))


def drain_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Process what is there, append it to a parquet table, and read it back.

    The table and the stream's own state both live in the shared folder.
    """
    spark = stream.sparkSession
    out, state = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def drain_complete(stream: DataFrame, name: str) -> DataFrame:
    """Process what is there and return the whole result of a named query in complete mode.

    The result is held by the driver: only for keys of a fixed, small domain such as status codes.
    """
    spark = stream.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("memory")
        .queryName(table)
        .outputMode("complete")
        .option("checkpointLocation", scratch_path(spark, f"{name}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.table(table)


def start_console(stream: DataFrame, name: str):
    """The interactive form: whole result to the console after every batch."""
    return stream.writeStream.format("console").queryName(name).outputMode("complete").start()
