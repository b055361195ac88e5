"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import percent
from millrace.ml.evaluate import matched_lists
from millrace.ml.recommend import item_mean_predictions
from millrace.operators import joins
from millrace.operators.aggregates import argmax, contingency_long, histogram
from millrace.operators.cleaning import suspicious_users
from millrace.operators.similarity import co_rated_sums
from millrace.plans import derived
from millrace.plans.catalog import query


@query(
    "join_inner_equi",
    """SELECT c_custkey, c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment""",
)
def _(t):
    aggs = [F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")]
    joined = joins.totals_joined(t.orders, "o_custkey", aggs, t.customer, "c_custkey")
    return joined.select("c_custkey", "c_mktsegment", "n", "total")


@query(
    "join_self_theta",
    f"""WITH {derived.RATINGS} SELECT a.item_id AS item1, b.item_id AS item2, CAST(sum(a.rating * b.rating) AS BIGINT) AS xy, count(*) AS n_pairs
    FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2 HAVING count(*) >= 3""",
)
def _(t):
    return co_rated_sums(derived.ratings(t), min_pairs=3).select("item1", "item2", "xy", "n_pairs")


@query(
    "join_left_outer_cond",
    "SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND d.lang = 'en'",
)
def _(t):
    docs = t.documents.select("doc_id", "lang")
    return joins.left_outer_where(docs, t.labels, "doc_id", F.col("lang") == "en")


@query("join_broadcast_lookup", "SELECT l_partkey, count(*) AS n, p_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, p_name")
def _(t):
    return joins.lookup(histogram(t.lineitem, "l_partkey"), t.part, "l_partkey", "p_partkey", ["p_name"])


@query(
    "join_cross",
    """SELECT 'l_returnflag' AS "left", 'l_linestatus' AS "right", l_returnflag AS left_value, l_linestatus AS right_value, count(*) AS n
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    UNION ALL SELECT 'l_returnflag', 'l_linenumber', l_returnflag, CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem GROUP BY l_returnflag, l_linenumber""",
)
def _(t):
    return contingency_long(t.lineitem, [("l_returnflag", "l_linestatus"), ("l_returnflag", "l_linenumber")])


@query(
    "join_pair_key",
    f"""WITH {derived.RATINGS}, means AS (SELECT item_id, avg(rating) AS m FROM ratings GROUP BY item_id)
    SELECT user_id, r.item_id, rating, round(m, 6) AS prediction, round(abs(rating - m), 6) AS miss FROM ratings r JOIN means USING (item_id)""",
)
def _(t):
    actual = derived.stored_ratings(t).select("user_id", "item_id", "rating")
    predicted = item_mean_predictions(actual).select("user_id", "item_id", "prediction")
    return actual.join(predicted, ["user_id", "item_id"]).select(
        "user_id",
        "item_id",
        "rating",
        F.round("prediction", 6).alias("prediction"),
        F.round(F.abs(F.col("rating") - F.col("prediction")), 6).alias("miss"),
    )


@query(
    "join_group_lists",
    f"""WITH {derived.RANKED} SELECT r.user_id, string_agg(CAST(r.item_id AS VARCHAR), ',' ORDER BY rank) AS predicted,
    count(l.item_id) AS hits, CAST(coalesce(any_value(n_actual), 0) AS BIGINT) AS n_actual
    FROM ranked r LEFT JOIN liked l ON r.user_id = l.user_id AND r.item_id = l.item_id
    LEFT JOIN (SELECT user_id, count(*) AS n_actual FROM liked GROUP BY user_id) a ON a.user_id = r.user_id GROUP BY r.user_id""",
)
def _(t):
    return matched_lists(*derived.lists(t))


@query(
    "join_point_lookup",
    """SELECT l_partkey, n, p_name FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey DESC LIMIT 1)
    JOIN part ON l_partkey = p_partkey""",
)
def _(t):
    best = argmax(histogram(t.lineitem, "l_partkey"), "n", "l_partkey")  # one row
    return t.part.join(F.broadcast(best), F.col("p_partkey") == F.col("l_partkey")).select("l_partkey", "n", "p_name")


@query(
    "join_anti_exclude",
    f"""WITH {derived.RATINGS}, flagged AS (SELECT user_id FROM ratings GROUP BY user_id
      HAVING count(*) > 20 AND (stddev_samp(ts) < 45000000 OR false))
    SELECT user_id, item_id, rating FROM ratings WHERE user_id NOT IN (SELECT user_id FROM flagged)""",
)
def _(t):
    r = derived.stored_ratings(t)
    flagged = suspicious_users(r, min_rows=20, max_stddev=45_000_000, max_share=100)
    return joins.exclude(r, flagged, "user_id").select("user_id", "item_id", "rating")


@query(
    "udf_lookup",
    "SELECT l_partkey, count(*) AS n, p_name AS title FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, p_name",
)
def _(t):
    return joins.lookup_by_udf(histogram(t.lineitem, "l_partkey"), t.part, "l_partkey", "p_partkey", "p_name", "title")


@query(
    "udf_pair_reduce",
    f"""WITH {derived.READINGS} SELECT station, count(*) AS n, CAST(sum(tenths) AS BIGINT) AS total, min(tenths) AS lowest, max(tenths) AS highest,
    round(sum(tenths) / count(*), 4) AS mean, round(100.0::DOUBLE * count(*) FILTER (tenths < 100) / count(*), 2) AS low_pct FROM readings GROUP BY station""",
)
def _(t):
    v = F.col("tenths")
    n = F.count(F.lit(1))
    return derived.readings(t).groupBy("station").agg(
        n.alias("n"),
        F.sum(v).alias("total"),
        F.min(v).alias("lowest"),
        F.max(v).alias("highest"),
        F.round(F.sum(v) / n, 4).alias("mean"),
        percent(F.count_if(v < 100), n).alias("low_pct"),
    )
