"""Metrics on deterministic predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.ml import curves, evaluate
from millrace.plans import derived
from millrace.plans.catalog import query

_RATES = (
    derived.CLASSES
    + """,
per AS (SELECT c AS class, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (label = c) AS n,
    count(*) FILTER (prediction = c) AS claimed, count(*) AS total
  FROM classes, (VALUES (0.0::DOUBLE), (1.0::DOUBLE), (2.0::DOUBLE)) AS v(c) GROUP BY c),
rates AS (SELECT class, n, total, coalesce(tp / nullif(claimed, 0), 0) AS p, coalesce(tp / nullif(n, 0), 0) AS r,
    coalesce((claimed - tp) / nullif(total - n, 0), 0) AS f FROM per)"""
)


@query(
    "ev_regression",
    f"""WITH {derived.PREDICTED} SELECT round(avg((label - prediction) ** 2), 2) AS mse, round(sqrt(avg((label - prediction) ** 2)), 2) AS rmse,
    round(avg(abs(label - prediction)), 2) AS mae, round(1 - avg((label - prediction) ** 2) / var_pop(label), 6) AS r2,
    round(avg((prediction - (SELECT avg(label) FROM predicted)) ** 2), 2) AS explained_variance FROM predicted""",
)
def _(t):
    return evaluate.regression_metrics(derived.predicted_prices(t), digits=2)


@query(
    "ev_multiclass",
    f"""WITH {_RATES} SELECT round(sum(n * r) / sum(n), 6) AS accuracy, round(sum(n * p) / sum(n), 6) AS weighted_precision,
    round(sum(n * r) / sum(n), 6) AS weighted_recall, round(sum(n * coalesce(2 * p * r / nullif(p + r, 0), 0)) / sum(n), 6) AS f1 FROM rates""",
)
def _(t):
    return evaluate.multiclass_metrics(derived.predicted_classes(t))


@query("ev_confusion_matrix", f"WITH {derived.CLASSES} SELECT label, prediction, count(*) AS n FROM classes GROUP BY 1, 2")
def _(t):
    return evaluate.confusion(derived.predicted_classes(t))


@query(
    "ev_confusion_by_label",
    f'WITH {_RATES} SELECT class, n, round(p, 6) AS "precision", round(r, 6) AS tpr, round(f, 6) AS fpr FROM rates',
)
def _(t):
    return evaluate.rates_by_label(evaluate.confusion(derived.predicted_classes(t)))


@query(
    "ev_error_rate",
    f"WITH {derived.CLASSES} SELECT round(avg(CASE WHEN label <> prediction THEN 100.0::DOUBLE ELSE 0 END), 4) AS error_pct, count(*) AS n FROM classes",
)
def _(t):
    return evaluate.error_rate(derived.predicted_classes(t))


_CURVE = (
    derived.SCORED
    + """,
hist AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS q FROM hist WINDOW w AS (ORDER BY score DESC))"""
)


@query("ev_binary_curves", f"WITH {_CURVE} SELECT round(score, 6) AS score, round(fp / q, 6) AS fpr, round(tp / p, 6) AS tpr FROM curve")
def _(t):
    return evaluate.roc_points(evaluate.score_curve(derived.scored_lines(t)))


@query(
    "ev_binary_areas",
    f"""WITH {_CURVE}, mid AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM scored),
    steps AS (SELECT *, tp / (tp + fp) AS here, coalesce((tp - pos) / nullif(tp - pos + fp - neg, 0), tp / (tp + fp)) AS before FROM curve)
    SELECT (SELECT round((sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0::DOUBLE)
      / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 6) FROM mid) AS area_roc,
    (SELECT round(sum(pos * (here + before) / 2) / sum(pos), 6) FROM steps) AS area_pr""",
)
def _(t):
    return evaluate.curve_areas(evaluate.score_curve(derived.scored_lines(t)))


_HITS = """,
hit AS (SELECT r.user_id, rank, CASE WHEN l.item_id IS NULL THEN 0 ELSE 1 END AS h FROM ranked r LEFT JOIN liked l USING (user_id, item_id)),
sized AS (SELECT user_id, count(*) AS n_actual FROM liked GROUP BY user_id),
cum AS (SELECT *, sum(h) OVER (PARTITION BY user_id ORDER BY rank) AS c FROM hit)"""
_AP = derived.RANKED + _HITS


def _ap_users(k: int) -> str:
    return f"""SELECT user_id, coalesce(any_value(n_actual), 0) AS n_actual, CAST(sum(h) AS BIGINT) AS hits,
      CASE WHEN any_value(n_actual) IS NULL THEN 1.0::DOUBLE
      ELSE sum(CASE WHEN h = 1 THEN c::DOUBLE / rank ELSE 0 END) / least(any_value(n_actual), {k}) END AS ap
      FROM cum LEFT JOIN sized USING (user_id) WHERE rank <= {k} GROUP BY user_id"""


@query("ev_average_precision", f"WITH {_AP} SELECT user_id, n_actual, hits, round(ap, 6) AS ap FROM ({_ap_users(10)})")
def _(t):
    return evaluate.average_precision(*derived.lists(t), 10)


_MAP_KS = (3, 10, 500)


@query(
    "ev_map_at_k",
    f"WITH {derived.ranked_sql(max(_MAP_KS))}{_HITS} "
    + " UNION ALL ".join(
        f"SELECT {k} AS k, count(*) AS users, round(sum(CASE WHEN n_actual > 0 THEN ap ELSE 0 END) / count(*), 6) AS map FROM ({_ap_users(k)})"
        for k in _MAP_KS
    ),
)
def _(t):
    """Lists as deep as the largest k."""
    return evaluate.map_at_k(*derived.lists(t, max(_MAP_KS)), _MAP_KS)


_DEEP = (10, 500, 2000)


@query(
    "ev_map_at_k_deep",
    f"WITH {derived.ranked_sql(max(_DEEP))}{_HITS} "
    + " UNION ALL ".join(
        f"SELECT {k} AS k, count(*) AS users, round(sum(CASE WHEN n_actual > 0 THEN ap ELSE 0 END) / count(*), 6) AS map FROM ({_ap_users(k)})"
        for k in _DEEP
    ),
)
def _(t):
    return evaluate.map_at_k(*derived.lists(t, max(_DEEP)), _DEEP)


_BINNED = (
    derived.SCORED
    + f""",
two_scores AS (SELECT 'plain' AS model, label, score FROM scored UNION ALL SELECT 'squared', label, score * score FROM scored),
hist AS (SELECT model, greatest(least(CAST(floor(score * {curves.BINS}) AS INTEGER), {curves.BINS - 1}), 0) AS bin, sum(label) AS pos, sum(1 - label) AS neg FROM two_scores GROUP BY ALL),
every AS (SELECT model, sum(pos) AS p, sum(neg) AS q, unnest(range({curves.BINS + 1})) AS point FROM hist GROUP BY model),
sums AS (SELECT e.model, CAST(e.point AS INTEGER) AS point, p, q, sum(coalesce(pos, 0)) OVER w AS tp, sum(coalesce(neg, 0)) OVER w AS fp
  FROM every e LEFT JOIN hist h ON h.model = e.model AND {curves.BINS} - h.bin = e.point WINDOW w AS (PARTITION BY e.model ORDER BY e.point)),
points AS (SELECT model, point, round(({curves.BINS} - point) / {curves.BINS}, 6) AS threshold, round(fp / q, 6) AS fpr, round(tp / p, 6) AS tpr,
  round(first_value(tp / nullif(tp + fp, 0) IGNORE NULLS) OVER (PARTITION BY model ORDER BY point ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 6) AS precision FROM sums)"""
)


@query("ev_histogram_curves", f"WITH {_BINNED} SELECT * FROM points")
def _(t):
    """ROC and precision-recall points of two scores, from one pass over the rows."""
    scored = derived.scored_lines(t)
    return curves.curve_points(curves.score_histograms(scored, {"plain": F.col("score"), "squared": F.col("score") * F.col("score")}))
