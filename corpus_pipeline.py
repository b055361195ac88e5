"""Training-data pipeline over documents: five stages, each written as Parquet and read by the next.

Quality network, divergence rules, line dedup, n-gram join, packing. Every stage works on all rows
its predecessor kept. The first four return the columns of documents; the last returns the packed
pieces with their token ids. Documents of which line dedup leaves nothing go with it; ``n_chars``
follows the text.

Defined results of every stage: a null text is empty, so the rules reject it; a null id is an id of
its own kind; rows are judged one by one, so equal rows share a verdict, and the n-gram join keeps one
of them. An empty table stays empty. Columns beside those of ``documents`` come along whatever their
names are.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import divergence_rules, line_runs, ngram_join, quality_cnn, slack_packing
from millrace.session import load
from millrace.storage import materialize

TOKENIZER = "word_bpe_49k.json"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def any_columns(stage):
    """``stage`` sees other columns under plain names, so that none meets a name that it uses itself."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = docs.toDF(*[c if c in DOCUMENT_COLUMNS else f"extra_column_{i}" for i, c in enumerate(docs.columns)])
        return stage(spark, plain, sf_dir).toDF(*docs.columns)

    return run_stage


@any_columns
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network does not reject; its labels are those of ``labels``."""
    net = quality_cnn.train(docs, load(spark, sf_dir, "labels"))
    return quality_cnn.score(docs, net).filter("predicted = 1").select(*docs.columns)


@any_columns
def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a language, by references from all documents given."""
    return divergence_rules.judge(docs).filter("kept").select(*docs.columns)


@any_columns
def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; those with no line left go."""
    left = line_runs.delete_repeated_runs(docs).filter("n_deleted_lines = 0 or text rlike '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]'")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("n_deleted_lines") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


@any_columns
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return ngram_join.keep_one(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of at most 2048."""
    pieces = slack_packing.cut_pieces(docs, public_tokenizers.path(TOKENIZER), keep=["doc_id"], most_cached=60_000)
    return slack_packing.pack(pieces)


STAGES = [
    ("quality classifier", quality_stage),
    ("quality rules", rules_stage),
    ("line dedup", lines_stage),
    ("n-gram Jaccard join", near_stage),
    ("best-fit packing", packing_stage),
]

#: SQL expresses none of network scores, prefix doubling or packing; tests/llm holds stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_").replace("-", "_"))
    return docs
