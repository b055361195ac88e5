"""Shared-folder storage: where intermediate tables, exchanged files and stream state live.

Everything an operator parks between jobs goes below ``spark.checkpoint.dir``, the folder the
cluster shares between executors, so that a lost executor never loses an intermediate result.
"""

from __future__ import annotations

import contextlib
import math
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a local-mode session without one gets a temporary folder."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="millrace-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/millrace/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and fixes its rows.

    Its shuffles go as soon as it is written, rather than when the driver next collects its garbage.
    """
    path = scratch_path(df.sparkSession, label)
    with _own_shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _own_shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is run inside drops its shuffle files at its end (Spark 4.1 on; before, the setting means nothing)."""
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_KEY)
        else:
            spark.conf.set(CLEANUP_KEY, before)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only after measuring that ``df`` stays below both bounds.

    The measurement takes row widths, at most ``max_rows + 1`` of them, reading partitions only
    until it has enough. Above the bounds the frame comes back without a hint, and Spark joins by
    shuffle, with AQE's skew handling.
    """
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    widths = [r[0] for r in df.select(width).limit(max_rows + 1).collect()]
    return F.broadcast(df) if len(widths) <= max_rows and sum(widths) <= max_bytes else df


def spread(df: DataFrame, *keys: str, rows: int = 250_000) -> DataFrame:
    """A stored frame dealt out by its keys: at most about ``rows`` rows a task, and work for every core.

    For fits that go over their rows many times and keep them: a stored table is read in parts of many
    megabytes, so a few columns of it would be held and worked on by a few tasks.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / rows))
    return df.repartition(parts, *keys)


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application, for tasks that run its functions in Python.

    Workers import such functions by name, whatever their working folder is.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="millrace-ship-"), "millrace.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
