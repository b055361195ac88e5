"""Session construction and table loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def build_session(
    app: str = "millrace", master: str | None = None, shuffle_partitions: int | None = None, **conf: object
) -> SparkSession:
    """A session with the settings the operators are written for: AQE on, UTC, ANSI left on.

    AQE merges small shuffle partitions but does not add any, so on large inputs
    ``shuffle_partitions`` should start high (about one per 256 MB shuffled); it is left to the
    cluster's setting when not given. Other settings come as ``spark__sql__name=value``.
    """
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = shuffle_partitions
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a test-data folder; columns and filters reach the scan lazily."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Tables:
    """Attribute access to the tables of one folder, e.g. ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._loaded: dict[str, DataFrame] = {}

    def _load(self, name: str) -> DataFrame:
        if name not in self._loaded:
            self._loaded[name] = load(self.spark, self.sf_dir, name)
        return self._loaded[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self._load(name)
        raise AttributeError(name)

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"
