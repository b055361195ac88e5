"""ROC and precision-recall curves of several fitted models at once, from histograms of their scores.

Every row adds to one bin per model, in its own task; only ``models x bins`` sums are shuffled, and
histograms of parts of a table may be added up. Rows whose label or score is null or not a number
count for nothing, rather than as negatives.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 15


def score_histograms(df: DataFrame, scores: Mapping[str, Column], label: str = "label", bins: int = BINS) -> DataFrame:
    """(model, bin, pos, neg) of scores from 0 to 1, by bins of equal width; scores beyond count in the outer bins."""
    of_model = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), c.cast("double").alias("score")) for m, c in scores.items()])).alias("s")
    rows = df.select(F.col(label).cast("double").alias("label"), of_model).select("label", "s.*")
    rows = rows.filter("label IS NOT NULL AND NOT isnan(label) AND score IS NOT NULL AND NOT isnan(score)")
    place = F.greatest(F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)), F.lit(0)).cast("int")
    return rows.groupBy("model", place.alias("bin")).agg(F.count_if(F.col("label") > 0.5).alias("pos"), F.count_if(F.col("label") <= 0.5).alias("neg"))


def merged(*histograms: DataFrame) -> DataFrame:
    """The histogram of all rows from those of their parts."""
    out = histograms[0]
    for other in histograms[1:]:
        out = out.unionByName(other)
    return out.groupBy("model", "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def curve_points(histograms: DataFrame, bins: int = BINS, digits: int = 6) -> DataFrame:
    """``bins + 1`` points per model from the strictest threshold to 0: (model, point, threshold, fpr, tpr, precision).

    Point 0 accepts nothing, with the precision of the first bin that holds a row; the last accepts
    all. ``tpr`` is the recall as well. A share of nothing is null.
    """
    # A bin counts in its own point and in all after it: at most bins x (bins + 1) rows per model, and no second scan.
    counted = F.col("point") >= bins - F.col("bin")
    sums = histograms.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins))).alias("point")).groupBy("model", "point").agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("q"),
        F.sum(F.when(counted, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(counted, F.col("neg")).otherwise(0)).alias("fp"),
    )
    # Points before the first that accepts a row take its precision.
    precision = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    listed = points_of_model(sums.withColumn("precision", precision), "point", "p", "q", "tp", "fp", "precision")
    first = F.get(F.filter("points", lambda x: x["precision"].isNotNull()), F.lit(0))["precision"]
    sums = listed.select("model", first.alias("first"), F.inline("points"))
    return sums.select(
        "model", "point", F.round((F.lit(bins) - F.col("point")) / bins, digits).alias("threshold"),
        F.round(F.try_divide(F.col("fp"), F.col("q")), digits).alias("fpr"), F.round(F.try_divide(F.col("tp"), F.col("p")), digits).alias("tpr"),
        F.round(F.coalesce("precision", "first"), digits).alias("precision"),
    )


def points_of_model(points: DataFrame, *columns: str) -> DataFrame:
    """(model, points): the few points of each model as one list, by the first of the columns."""
    return points.groupBy("model").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("points"))


def areas(points: DataFrame, digits: int = 6) -> DataFrame:
    """(model, area_roc) by trapezoids between the points; within half a bin's pairs of the exact area."""
    listed = points_of_model(points, "point", "fpr", "tpr").withColumn("n", F.size("points") - 1)
    before, after = F.slice("points", F.lit(1), F.col("n")), F.slice("points", F.lit(2), F.col("n"))
    steps = F.zip_with(before, after, lambda a, b: (b["fpr"] - a["fpr"]) * (b["tpr"] + a["tpr"]) / 2)
    return listed.select("model", F.explode_outer(steps).alias("step")).groupBy("model").agg(F.round(F.sum("step"), digits).alias("area_roc"))
