"""Histogram curves against counting, by hand and at random; parts add up; missing labels and scores count for nothing."""

import random

from pyspark.sql import functions as F

from conftest import rows
from millrace.ml import curves, evaluate


def test_points_match_counting(spark):
    rng = random.Random(2)
    data = [(float(rng.random() < s), s) for s in [rng.choice([0.0, 1.0, rng.random(), rng.random() ** 3]) for _ in range(500)]]
    noise = [(None, 0.9), (1.0, None), (0.0, float("nan")), (float("nan"), 0.5)]
    df = spark.createDataFrame(data + noise, "label double, score double")
    scores = {"a": F.col("score"), "b": 1 - F.col("score"), "far": F.col("score") * 3 - 1}
    hist = curves.score_histograms(df, scores, bins=15)
    points = {(r["model"], r["point"]): r for r in curves.curve_points(hist).collect()}
    assert len(points) == 3 * 16
    for model, f in (("a", lambda s: s), ("b", lambda s: 1 - s), ("far", lambda s: s * 3 - 1)):
        placed = [(y, max(0, min(14, int(f(s) * 15 // 1)))) for y, s in data]
        p, q = sum(y for y, _ in placed), sum(1 - y for y, _ in placed)
        for point in range(16):
            taken = [y for y, b in placed if 15 - b <= point]
            r = points[model, point]
            assert abs(r["tpr"] - sum(taken) / p) < 1e-6 and abs(r["fpr"] - (len(taken) - sum(taken)) / q) < 1e-6
            if taken:
                assert abs(r["precision"] - sum(taken) / len(taken)) < 1e-6
    exact = evaluate.curve_areas(evaluate.score_curve(df.filter("NOT isnan(label) AND NOT isnan(score)"))).first()["area_roc"]
    assert abs({r["model"]: r["area_roc"] for r in curves.areas(curves.curve_points(hist)).collect()}["a"] - exact) < 0.02


def test_parts_add_up(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("double").alias("label"), (F.col("id") % 97 / 97).alias("score"))
    whole, halves = (curves.score_histograms(d, {"m": F.col("score")}) for d in (df, df.limit(0))), [df.filter("score < 0.4"), df.filter("score >= 0.4")]
    whole, empty = whole
    parts = curves.merged(empty, *[curves.score_histograms(d, {"m": F.col("score")}) for d in halves])
    assert rows(parts) == rows(whole) and curves.curve_points(empty).count() == 0


def test_rows_without_a_label_are_no_negatives(spark):
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.1), (None, 0.95)], "label double, score double")
    assert rows(evaluate.curve_areas(evaluate.score_curve(df)))[0][0] == 1.0


def test_points_before_the_first_row_take_its_precision(spark):
    hist = spark.createDataFrame([("m", 1, 3, 1), ("m", 0, 0, 4), ("m", 3, 0, 0), ("none", 2, 0, 0)], "model string, bin int, pos long, neg long")
    points = curves.curve_points(hist, bins=4)
    assert rows(points.filter("model = 'm'").drop("model")) == [
        (0, 1.0, 0.0, 0.0, 0.75), (1, 0.75, 0.0, 0.0, 0.75), (2, 0.5, 0.0, 0.0, 0.75), (3, 0.25, 0.2, 1.0, 0.75), (4, 0.0, 1.0, 1.0, 0.375),
    ]
    assert {r[3:] for r in rows(points.filter("model = 'none'"))} == {(None, None, None)}
    assert rows(curves.areas(points)) == [("m", 0.9), ("none", None)]
    plan = curves.areas(points)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
