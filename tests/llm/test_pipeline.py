"""The pipeline's stages, each on what its predecessor kept, and the registered queries."""

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF
from millrace.llm.queries import all_queries, all_sql
from millrace.llm.token_ids import encode
from millrace.session import TABLES, load
from millrace.storage import materialize
from tools.check import TYPES, canonical


def test_stages_take_effect_and_keep_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = docs.filter("length(text) between 1500 and 3000 and lang = 'en'").orderBy("doc_id").limit(1).first()
    copy = (9001, good.text, "en", "s", len(good.text))
    junk = (9002, "word&&& other### " * 150, "en", "s", 2400)
    extra = spark.createDataFrame([copy, junk, (9003, None, None, None, None), (None, "", "en", "s", 0)], docs.schema)
    now = docs.unionByName(extra)
    ids = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, SF)
        out.write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert out.columns == docs.columns
            ids.append({r.doc_id for r in out.select("doc_id").collect()})
            now = out
    kept = [len(x) for x in ids]
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0.5 * docs.count()
    assert 9002 not in ids[1] and 9003 not in ids[1]
    assert good.doc_id in ids[-1] and 9001 not in ids[-1]
    left = now.toPandas()
    want = encode(pa.array(left["text"].tolist()), public_tokenizers.path("word_bpe_49k.json"), False)[0]
    packed = out.toPandas()
    assert packed["length"].sum() == len(want) and set(packed["doc_id"]) == set(left["doc_id"])


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    names = ["_k1", "_g1", "_gone", "_id", "_label", "score", "predicted", "kept", "n_words", "a.b", "_nth", "extra"]
    docs = load(spark, SF, "documents").limit(60)
    docs = docs.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in names])
    for column in ("text", "doc_id", "lang"):
        docs = docs.unionByName(docs.limit(2).withColumn(column, F.lit(None).cast(docs.schema[column].dataType)))
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = docs
        docs = materialize(stage(spark, docs, SF), "stage")
        assert docs.columns == before.columns
        same = F.lit(True)
        for n in names:
            same &= F.col("doc_id").isNull() | (F.col(f"`{n}`") == F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")))
        assert docs.filter(~same).count() == 0 and 0 < docs.count() <= before.count(), name
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_pipeline_of_an_empty_table(spark):
    now = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
    assert now.count() == 0


@pytest.mark.parametrize("key", sorted(all_sql()))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    df = all_queries()[key](spark, SF)
    cur = con.execute(all_sql()[key])
    names, types = [d[0] for d in cur.description], [TYPES.get(str(d[1])) for d in cur.description]
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == dict(zip(names, types))
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cur.fetchall(), names)
