"""Metrics as DataFrame algebra: one aggregation each, comparable with the library evaluators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranking import top_per_key, with_position, with_running_sums


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """mse, rmse, mae, r2 and explained variance in one row."""
    y, p = F.col(label), F.col(prediction)
    err = y - p
    parts = df.agg(
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.var_pop(y).alias("vy"),
        F.var_pop(p).alias("vp"),
        F.avg(p).alias("mp"),
        F.avg(y).alias("my"),
    )
    gap = F.col("mp") - F.col("my")
    return parts.select(
        F.round("mse", digits).alias("mse"),
        F.round(F.sqrt("mse"), digits).alias("rmse"),
        F.round("mae", digits).alias("mae"),
        F.round(1 - F.try_divide(F.col("mse"), F.col("vy")), max(digits, 6)).alias("r2"),
        F.round(F.col("vp") + gap * gap, digits).alias("explained_variance"),
    )


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def rates_by_label(cells: DataFrame, digits: int = 6) -> DataFrame:
    """Precision, true and false positive rate per class, from confusion cells.

    The cells number at most the square of the classes, so the joins below are on tiny frames.
    """
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("bigint").alias("claimed"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    F.lit(0).cast("bigint").alias("tp"),
                    F.lit(0).cast("bigint").alias("actual"),
                    F.col("n").alias("claimed"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    per_class = sides.groupBy("class").agg(F.sum("tp").alias("tp"), F.sum("actual").alias("actual"), F.sum("claimed").alias("claimed"))
    total = cells.agg(F.sum("n").alias("t")).scalar()
    tp, actual, claimed = F.col("tp"), F.col("actual"), F.col("claimed")
    return per_class.withColumn("total", total).select(
        "class",
        actual.alias("n"),
        F.round(F.coalesce(F.try_divide(tp, claimed), F.lit(0.0)), digits).alias("precision"),
        F.round(F.coalesce(F.try_divide(tp, actual), F.lit(0.0)), digits).alias("tpr"),
        F.round(F.coalesce(F.try_divide(claimed - tp, F.col("total") - actual), F.lit(0.0)), digits).alias("fpr"),
    )


def multiclass_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """Accuracy and label-weighted precision, recall and F1 in one row."""
    rates = rates_by_label(confusion(df, label, prediction), digits=15)
    w, p, r = F.col("n"), F.col("precision"), F.col("tpr")
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    n = F.sum(w)
    return rates.agg(
        F.round(F.sum(w * r) / n, digits).alias("accuracy"),
        F.round(F.sum(w * p) / n, digits).alias("weighted_precision"),
        F.round(F.sum(w * r) / n, digits).alias("weighted_recall"),
        F.round(F.sum(w * f1) / n, digits).alias("f1"),
    )


def error_rate(df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 4) -> DataFrame:
    """Percentage of rows whose prediction differs from the label."""
    wrong = F.when(F.col(label) != F.col(prediction), 100.0).otherwise(0.0)
    return df.agg(F.round(F.avg(wrong), digits).alias("error_pct"), F.count(F.lit(1)).alias("n"))


def score_curve(df: DataFrame, score: str = "score", label: str = "label", bins: int = 0) -> DataFrame:
    """Cumulative true and false positives by falling score: (score, pos, neg, tp, fp).

    Rows collapse to one per distinct score first. With ``bins``, neighbouring scores are merged
    into about that many points. Rows without a label or a score count for nothing.
    """
    hits = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) > 0.5, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) > 0.5, 0).otherwise(1)).alias("neg"),
    )
    if bins:
        placed = with_position(hits, [F.desc("score")], "at")
        size = placed.count() // bins
        if size >= 2:
            chunk = F.floor(F.col("at") / size)
            placed = placed.groupBy(chunk.alias("chunk")).agg(
                F.max("score").alias("score"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
            )
        hits = placed.select("score", "pos", "neg")
    return with_running_sums(hits, [F.desc("score")], {"tp": F.col("pos"), "fp": F.col("neg")})


def roc_points(curve: DataFrame, digits: int = 6) -> DataFrame:
    """One ROC point per score: share of negatives and of positives scored at least that high."""
    all_pos = curve.agg(F.sum("pos").alias("p")).scalar()
    all_neg = curve.agg(F.sum("neg").alias("q")).scalar()
    return curve.select(
        F.round("score", digits).alias("score"),
        F.round(F.try_divide(F.col("fp"), all_neg), digits).alias("fpr"),
        F.round(F.try_divide(F.col("tp"), all_pos), digits).alias("tpr"),
    )


def curve_areas(curve: DataFrame, digits: int = 6) -> DataFrame:
    """Areas under the ROC and the precision-recall curve (trapezoids; tied scores count half)."""
    tp, fp, pos, neg = F.col("tp"), F.col("fp"), F.col("pos"), F.col("neg")
    tp0, fp0 = tp - pos, fp - neg
    here = tp / (tp + fp)
    before = F.coalesce(F.try_divide(tp0, tp0 + fp0), here)
    p, q = F.sum(pos), F.sum(neg)
    return curve.agg(
        F.round(F.try_divide(F.sum(neg * (tp + tp0) / 2.0), p.cast("double") * q), digits).alias("area_roc"),
        F.round(F.try_divide(F.sum(pos * (here + before) / 2.0), p.cast("double")), digits).alias("area_pr"),
    )


def ranked_predictions(scored: DataFrame, score: str, k: int) -> DataFrame:
    """Each user's ``k`` best items, ranked from 1; among equals the smaller item id first."""
    top = top_per_key(scored, ["user_id"], [F.desc(score), F.col("item_id")], k)
    return top.select("user_id", "item_id", "rank")


def matched_lists(ranked: DataFrame, actual: DataFrame) -> DataFrame:
    """Per ranked user: the ranked items as text, how many are actual ones, how many actual ones there are.

    The only list built is the ranked one, which its ``k`` bounds.
    """
    truth = actual.select("user_id", "item_id").distinct().withColumn("hit", F.lit(1))
    found = ranked.join(truth, ["user_id", "item_id"], "left")
    in_order = F.sort_array(F.collect_list(F.struct("rank", "item_id")))
    per_user = found.groupBy("user_id").agg(
        F.array_join(F.transform(in_order, lambda e: e["item_id"].cast("string")), ",").alias("predicted"),
        F.count("hit").alias("hits"),
    )
    sizes = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_actual"))
    return per_user.join(sizes, "user_id", "left").withColumn("n_actual", F.coalesce("n_actual", F.lit(0)))


def _precision_sums(ranked: DataFrame, actual: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Per ranked user, for every ``k`` in one pass: (user_id, n_actual, score_k, hits_k, ...).

    The lists stay in long form: a user's actual items are matched by a join instead of being
    gathered, and the window only sees the ranked rows, at most ``max(ks)`` per user.
    """
    shown = ranked.filter(F.col("rank") <= max(ks))
    truth = actual.select("user_id", "item_id").distinct().withColumn("hit", F.lit(1))
    found = shown.join(truth, ["user_id", "item_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    w = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    part = F.when(F.col("hit") == 1, F.sum("hit").over(w) / F.col("rank")).otherwise(0.0)
    sums = []
    for k in ks:
        inside = F.col("rank") <= k
        sums.append(F.sum(F.when(inside, F.col("part")).otherwise(0.0)).alias(f"score_{k}"))
        sums.append(F.sum(F.when(inside, F.col("hit")).otherwise(0)).alias(f"hits_{k}"))
    per_user = found.withColumn("part", part).groupBy("user_id").agg(*sums)
    sizes = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_actual"))
    return per_user.join(sizes, "user_id", "left").withColumn("n_actual", F.coalesce("n_actual", F.lit(0)))


def _ap(k: int) -> Column:
    return F.try_divide(F.col(f"score_{k}"), F.least("n_actual", F.lit(k)))


def average_precision(ranked: DataFrame, actual: DataFrame, k: int, digits: int = 6) -> DataFrame:
    """Average precision at ``k`` per ranked user: (user_id, n_actual, hits, ap).

    A user with no actual item scores 1.
    """
    ap = F.when(F.col("n_actual") == 0, 1.0).otherwise(_ap(k))
    sums = _precision_sums(ranked, actual, [k])
    return sums.select("user_id", "n_actual", F.col(f"hits_{k}").alias("hits"), F.round(ap, digits).alias("ap"))


def map_at_k(ranked: DataFrame, actual: DataFrame, ks: Sequence[int], digits: int = 6) -> DataFrame:
    """Mean average precision for several ``k``; users without actual items add nothing to the sum."""
    n = F.count(F.lit(1))
    rows = [
        F.struct(
            F.lit(k).alias("k"), n.alias("users"), F.round(F.sum(F.coalesce(_ap(k), F.lit(0.0))) / n, digits).alias("map")
        )
        for k in ks
    ]
    one = _precision_sums(ranked, actual, ks).agg(F.array(*rows).alias("m"))
    return one.select(F.explode("m").alias("m")).select("m.*")


def silhouette(df: DataFrame, cluster: str = "prediction", features: str = "features", distance: str = "squaredEuclidean") -> float:
    return ClusteringEvaluator(predictionCol=cluster, featuresCol=features, distanceMeasure=distance).evaluate(df)
