"""Windows, sorts, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import ranking, sampling
from millrace.operators.aggregates import argmax, histogram, share_of_total
from millrace.operators.joins import lookup
from millrace.operators.sets import except_rows
from millrace.plans import derived
from millrace.plans.catalog import query
from millrace.storage import materialize, spread

R = ["user_id", "item_id", "rating", "ts"]


@query("win_latest_per_key", f"WITH {derived.RATINGS} SELECT user_id, item_id, rating, ts FROM ratings")
def _(t):
    return derived.newest(derived.raw_ratings(t))


@query(
    "win_row_number",
    "SELECT p_brand, p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS BIGINT) AS rank FROM part",
)
def _(t):
    order = [F.desc("p_retailprice"), F.col("p_partkey")]
    return ranking.rank_within(t.part.select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], order).select("p_brand", "p_partkey", "rank")


@query(
    "win_share_of_total",
    """SELECT l_returnflag, l_linestatus, l_linenumber, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 4) AS pct
    FROM (SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2, 3)""",
)
def _(t):
    return share_of_total(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"])


@query(
    "win_holdout_per_user",
    f"""WITH {derived.RATINGS} SELECT user_id, item_id, CASE WHEN rn BETWEEN 1 AND 10 THEN 'test' ELSE 'base' END AS part FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS rn FROM ratings)""",
)
def _(t):
    order = [F.col("ts"), F.col("item_id")]
    base, test = sampling.holdout_per_key(derived.stored_ratings(t), "user_id", ["user_id", "item_id"], order, 1, 10)
    pick = ["user_id", "item_id"]
    return base.select(*pick, F.lit("base").alias("part")).union(test.select(*pick, F.lit("test").alias("part")))


@query(
    "win_kfold_contiguous",
    f"WITH {derived.RATINGS} SELECT user_id, item_id, CAST(ntile(5) OVER (ORDER BY ts, user_id, item_id) AS INTEGER) AS fold FROM ratings",
)
def _(t):
    order = [F.col("ts"), F.col("user_id"), F.col("item_id")]
    return sampling.contiguous_folds(derived.ratings(t), 5, order).select("user_id", "item_id", "fold")


@query("sort_asc_desc", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rows.orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query(
    "topk_rows",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 20",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return rows.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(20)


@query("top1_argmax", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey DESC LIMIT 1")
def _(t):
    return argmax(histogram(t.lineitem, "l_partkey"), "n", "l_partkey")


@query(
    "topk_per_user_rated",
    f"""WITH {derived.RATINGS} SELECT user_id, item_id, rating, name, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM ratings)
    JOIN (SELECT p_partkey, p_name AS name FROM part) ON item_id = p_partkey WHERE rank <= 5""",
)
def _(t):
    top = ranking.top_per_key(derived.ratings(t), ["user_id"], [F.desc("rating"), F.col("item_id")], 5)
    named = lookup(top, derived.item_names(t), "item_id", "id", ["name"])
    return named.select("user_id", "item_id", "rating", "name", "rank")


@query(
    "set_except",
    f"""WITH {derived.RATINGS} SELECT user_id, item_id, rating FROM raw_ratings EXCEPT SELECT user_id, item_id, rating FROM ratings""",
)
def _(t):
    cols = ["user_id", "item_id", "rating"]
    # A rating's newest time is all that counts of its copies. With at most five rows a pair left, pairs are
    # dealt out by measured rows, which bounds what the window of a task sorts.
    raw = materialize(derived.raw_ratings(t), "raw_ratings")
    raw = materialize(raw.groupBy(*cols).agg(F.max("ts").alias("ts")), "raw_ratings")
    newest = derived.newest(spread(raw, "user_id", "item_id"))
    return except_rows(raw.select(*cols), newest.select(*cols))


@query("set_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _(t):
    return t.orders.select("o_custkey", "o_orderstatus").distinct()
