"""Cleaning, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import cleaning, sampling
from millrace.plans import derived
from millrace.plans.catalog import query

_U = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


@query("cln_drop_null", f"WITH {derived.LABELLED} SELECT doc_id, lang, quality, toxic FROM labelled WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def _(t):
    return derived.labelled(t).na.drop(subset=["quality", "toxic"]).select("doc_id", "lang", "quality", "toxic")


@query(
    "cln_fill_mean",
    f"""WITH {derived.LABELLED} SELECT doc_id, coalesce(quality, CAST(trunc((SELECT avg(quality) FROM labelled)) AS INTEGER)) AS quality,
    round(coalesce(CAST(toxic AS DOUBLE), (SELECT avg(toxic) FROM labelled)), 6) AS toxic FROM labelled""",
)
def _(t):
    rows = derived.labelled(t).select("doc_id", "quality", F.col("toxic").cast("double").alias("toxic"))
    return cleaning.fill_mean(rows, ["quality", "toxic"]).withColumn("toxic", F.round("toxic", 6))


@query("cln_fill_const", f"WITH {derived.LABELLED} SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM labelled")
def _(t):
    return derived.labelled(t).na.fill({"quality": -1, "toxic": 0}).select("doc_id", "quality", "toxic")


@query(
    "cln_sentinel_to_mode",
    f"""WITH {derived.MARKED},
    pm AS (SELECT priority AS m FROM marked WHERE priority <> '?' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    sm AS (SELECT status AS m FROM marked WHERE status <> '?' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT o_orderkey, CASE WHEN priority = '?' THEN (SELECT m FROM pm) ELSE priority END AS priority,
    CASE WHEN status = '?' THEN (SELECT m FROM sm) ELSE status END AS status FROM marked""",
)
def _(t):
    return cleaning.marker_to_mode(derived.marked_orders(t), ["priority", "status"]).select("o_orderkey", "priority", "status")


@query(
    "cln_outlier_iqr_drop",
    """WITH q AS (SELECT quantile_disc(l_extendedprice, 0.25) AS a, quantile_disc(l_extendedprice, 0.75) AS b,
      quantile_disc(l_quantity, 0.25) AS c, quantile_disc(l_quantity, 0.75) AS d FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, q
    WHERE l_extendedprice BETWEEN a - 0.4::DOUBLE * (b - a) AND b + 0.4::DOUBLE * (b - a)
      AND l_quantity BETWEEN c - 0.4::DOUBLE * (d - c) AND d + 0.4::DOUBLE * (d - c)""",
)
def _(t):
    kept = cleaning.drop_iqr_outliers(t.lineitem, ["l_extendedprice", "l_quantity"], factor=0.4)
    return kept.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "cln_winsorize",
    """WITH q AS (SELECT quantile_disc(l_extendedprice, 0.05) AS a, quantile_disc(l_extendedprice, 0.95) AS b,
      quantile_disc(l_quantity, 0.05) AS c, quantile_disc(l_quantity, 0.95) AS d FROM lineitem)
    SELECT l_orderkey, l_linenumber, least(greatest(l_extendedprice, a), b) AS l_extendedprice,
    least(greatest(l_quantity, c), d) AS l_quantity FROM lineitem, q""",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return cleaning.winsorize(rows, ["l_extendedprice", "l_quantity"])


@query(
    "cln_suspicious_users",
    f"""WITH {derived.RATINGS}, per AS (SELECT user_id, count(*) AS n, stddev_samp(ts) AS sd FROM ratings GROUP BY user_id),
    top AS (SELECT user_id, max(m) AS most FROM (SELECT user_id, rating, count(*) AS m FROM ratings GROUP BY 1, 2) GROUP BY 1),
    flagged AS (SELECT user_id FROM per JOIN top USING (user_id)
      WHERE n > 20 AND (sd < 45000000 OR round(most * 100.0::DOUBLE / n, 2) > 40))
    SELECT user_id, item_id, rating, ts FROM ratings WHERE user_id NOT IN (SELECT user_id FROM flagged)""",
)
def _(t):
    return cleaning.drop_suspicious(derived.stored_ratings(t), min_rows=20, max_stddev=45_000_000, max_share=40.0).select(
        "user_id", "item_id", "rating", "ts"
    )


@query("smp_random_split", "SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, true AS shares_fit FROM orders")
def _(t):
    parts = sampling.random_split(t.orders.select("o_orderkey", "o_totalprice"), [0.6, 0.2, 0.2], seed=10)
    named = [p.withColumn("part", F.lit(n)) for p, n in zip(parts, ("train", "validation", "test"))]
    # Six deviations of a binomial count from its share, per part.
    off = [F.abs(F.count_if(F.col("part") == n) - F.count(F.lit(1)) * w) <= 6 * F.sqrt(F.count(F.lit(1)) * w * (1 - w)) for n, w in (("train", 0.6), ("validation", 0.2), ("test", 0.2))]
    return named[0].union(named[1]).union(named[2]).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys"), (off[0] & off[1] & off[2]).alias("shares_fit"))


@query(
    "smp_hash_split",
    f"""SELECT o_orderkey, CASE WHEN u < 0.6 THEN 0 WHEN u < 0.8 THEN 1 ELSE 2 END AS split
    FROM (SELECT o_orderkey, {_U.format("'s|' || o_orderkey")} AS u FROM orders)""",
)
def _(t):
    return sampling.hash_split(t.orders.select("o_orderkey"), ["o_orderkey"], [0.6, 0.2, 0.2], salt="s")


_FRACTIONS = {1: 0.8, 2: 0.8, 3: 0.8, 4: 0.8, 5: 0.8}


@query("smp_stratified", f"WITH {derived.RATINGS} SELECT rating, count(*) AS n, true AS share_fits FROM ratings GROUP BY rating")
def _(t):
    r = derived.stored_ratings(t)
    kept = sampling.stratified(r, "rating", _FRACTIONS, seed=10).groupBy(F.col("rating").alias("_r")).agg(F.count(F.lit(1)).alias("kept"))
    sizes = r.groupBy("rating").agg(F.count(F.lit(1)).alias("n")).join(kept, F.col("rating") == F.col("_r"), "left")
    return sizes.select("rating", "n", (F.abs(F.col("kept") - F.col("n") * 0.8) <= 6 * F.sqrt(F.col("n") * 0.8 * 0.2)).alias("share_fits"))


@query(
    "smp_stratified_hash",
    f"""WITH {derived.RATINGS} SELECT user_id, item_id, rating FROM (
      SELECT *, {_U.format("'st|' || user_id || '|' || item_id")} AS u FROM ratings)
    WHERE u < CASE rating WHEN 1 THEN 0.2 WHEN 2 THEN 0.4 WHEN 5 THEN 0.9 ELSE 0 END""",
)
def _(t):
    kept = sampling.stratified_by_hash(derived.ratings(t), "rating", {1: 0.2, 2: 0.4, 5: 0.9}, ["user_id", "item_id"], salt="st")
    return kept.select("user_id", "item_id", "rating")
