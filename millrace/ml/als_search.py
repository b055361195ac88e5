"""Grid search for matrix factorisation by cross-validation over ratings."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import unit_hash
from millrace.ml.block_als import FactorModel
from millrace.ml.recommend import Fits, fit_als
from millrace.storage import materialize


def with_folds(ratings: DataFrame, folds: int) -> DataFrame:
    """``ratings`` with a ``fold``, from a hash of user and item, so that a rerun gives the same folds."""
    return ratings.withColumn("fold", F.floor(unit_hash(F.col("user_id"), F.col("item_id"), salt="fold") * folds).cast("int"))


def _errors(scored: DataFrame) -> tuple[float | None, int, int]:
    """(rmse of the scored rows, rows scored, rows without a score)."""
    known = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    error = F.when(known, F.col("rating") - F.col("prediction"))
    r = scored.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.count_if(known).alias("n"), F.count_if(~known).alias("cold")).first()
    return r["rmse"], r["n"], r["cold"]


def search(
    ratings: DataFrame, candidates: Sequence[tuple[int, float]], folds: int = 2, iterations: int = 10, seed: int = 1, parallelism: int = 4
) -> tuple[ALSModel | FactorModel, tuple[int, float], DataFrame]:
    """Fit every (rank, reg) on all folds but one and score that one; refit the best on all ratings.

    Ratings (``user_id`` int, ``item_id`` int, ``rating``) are stored once with their fold; fits run side by
    side. A row whose user or item is not in the training folds has no score: it is counted, not lost.
    Returns (model, best, table): the table has a row per candidate with rank, reg, rmse (mean of the
    folds'), n_scored, n_dropped and whether it was chosen (least rmse, ties to the first).
    """
    stored = materialize(with_folds(ratings.select("user_id", "item_id", "rating"), folds), "folds")

    training = [Fits(stored.filter(F.col("fold") != fold)) for fold in range(folds)]

    def one(job: tuple[int, float, int]) -> tuple[float | None, int, int]:
        rank, reg, fold = job
        model = training[fold].fit(rank, iterations, reg, seed, cold="nan")
        found = _errors(model.transform(stored.filter(F.col("fold") == fold)))
        if isinstance(model, FactorModel):
            model.release()
        return found

    jobs = [(rank, reg, fold) for rank, reg in candidates for fold in range(folds)]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        found = pool.map(inheritable_thread_target(ratings.sparkSession)(one), jobs)
    for fits in training:
        fits.release()
    rows = []
    for i, (rank, reg) in enumerate(candidates):
        parts = found[i * folds : (i + 1) * folds]
        known = [p[0] for p in parts if p[0] is not None]
        rmse = float(sum(known) / len(known)) if known else None
        rows.append((rank, float(reg), rmse, sum(p[1] for p in parts), sum(p[2] for p in parts)))
    scored = [i for i, r in enumerate(rows) if r[2] is not None]
    if not scored:
        raise ValueError("no rating of any fold has its user and item in the other folds")
    best = min(scored, key=lambda i: rows[i][2])
    table = [(*r, i == best) for i, r in enumerate(rows)]
    schema = "rank int, reg double, rmse double, n_scored bigint, n_dropped bigint, chosen boolean"
    rank, reg = candidates[best]
    model = fit_als(stored, rank, iterations, reg, seed)
    return model, (rank, reg), ratings.sparkSession.createDataFrame(table, schema)


def item_mean_rmse(ratings: DataFrame, folds: int = 2) -> float | None:
    """What the mean rating of the item in the other folds comes to on the same folds."""
    stored = materialize(with_folds(ratings.select("user_id", "item_id", "rating"), folds), "folds")
    found = []
    for fold in range(folds):
        means = stored.filter(F.col("fold") != fold).groupBy("item_id").agg(F.avg("rating").alias("prediction"))
        found.append(_errors(stored.filter(F.col("fold") == fold).join(materialize(means, "means"), "item_id", "left"))[0])
    known = [r for r in found if r is not None]
    return sum(known) / len(known) if known else None
