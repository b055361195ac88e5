"""Cleaning stages: what they learn, and that another session gives the same rows from the saved pipeline."""

import os
import subprocess
import sys

from pyspark.ml import Pipeline, PipelineModel

from conftest import ROOT, rows
from millrace.ml import features
from millrace.ml.estimators import estimator
from millrace.ml.stages import Clip, ClipModel, FillMode, FillModeModel, Intervals, census_cleaning


def people(spark, n=400, shift=0):
    data = [(i, (i * 7 + shift) % 120, float((i * 31 + shift) % 9000) if i % 11 else None, "?" if i % 3 == 0 else "abc"[i % 2], i % 2) for i in range(n)]
    return spark.createDataFrame(data, "id long, age int, wage_per_hour double, job string, income int")


def test_stages_learn_from_training_rows_alone(spark):
    train = spark.createDataFrame([(float(i), "?" if i % 2 else "xy"[i % 3 > 0], None) for i in range(101)], "v double, c string, e double")
    limits = Clip(["v", "e"], 0.1, 0.9).fit(train)
    assert isinstance(limits, ClipModel) and limits.getInputCols() == ["v"]
    filled = FillMode(["c"]).fit(train)
    assert isinstance(filled, FillModeModel) and filled.getOrDefault(filled.modes) == ["y"]
    new = spark.createDataFrame([(-5.0, "?", 1.0), (500.0, "x", None), (None, None, None)], "v double, c string, e double")
    assert rows(filled.transform(limits.transform(new)).select("v", "c", "e")) == rows(spark.createDataFrame([(10.0, "y", 1.0), (90.0, "x", None), (None, None, None)], "v double, c string, e double"))


def test_interval_edges_and_defaults(spark):
    df = spark.createDataFrame([(0,), (18,), (19,), (101,), (None,)], "age int")
    given = Intervals("age", "b", [0, 18, 35], ["young", "grown"])
    assert [r["b"] for r in given.transform(df).collect()] == ["young", "young", "grown", "Out", "Out"]
    plain = Intervals("age", "b", [0, 18], default="none")
    assert [r["b"] for r in plain.transform(df).collect()] == ["0-18", "0-18", "none", "none", "none"]


def pipeline():
    numbers = list(features.CENSUS_EDGES)
    cleaning = [s for s in census_cleaning(["job"], ["wage_per_hour"]) if not isinstance(s, Intervals) or s.getInputCol() in numbers[:2]]
    codes = features.indexer(["job", "age_bin", "wage_per_hour_bin"])
    tree = estimator("decision_tree_clf", labelCol="income", maxDepth=3, seed=1)
    return Pipeline(stages=[*cleaning, codes, features.assembler(codes.getOutputCols()), tree])


SCORE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.ml import PipelineModel
from millrace.session import build_session
spark = build_session("later", "local[2]", shuffle_partitions=2, spark__ui__enabled="false")
found = PipelineModel.load(sys.argv[2]).transform(spark.read.parquet(sys.argv[3]))
found.select("id", "wage_per_hour", "job", "age_bin", "wage_per_hour_bin", "prediction").write.parquet(sys.argv[4])
"""


def test_another_session_scores_alike(spark, tmp_path):
    model = pipeline().fit(people(spark))
    model.write().overwrite().save(f"{tmp_path}/model")
    new = people(spark, 300, 55)
    new.write.parquet(f"{tmp_path}/new")
    subprocess.run([sys.executable, "-c", SCORE, ROOT, f"{tmp_path}/model", f"{tmp_path}/new", f"{tmp_path}/scored"], check=True, env=os.environ, timeout=300)
    columns = ["id", "wage_per_hour", "job", "age_bin", "wage_per_hour_bin", "prediction"]
    expect = rows(model.transform(new).select(*columns))
    assert rows(spark.read.parquet(f"{tmp_path}/scored").select(*columns)) == expect and len(expect) == 300
    assert len({r[-1] for r in expect}) == 2 and "?" not in {r[2] for r in expect}
    loaded = PipelineModel.load(f"{tmp_path}/model")
    assert [type(s) for s in loaded.stages] == [type(s) for s in model.stages]
