"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.strings import tokens
from millrace.operators.filters import equals_marker, rows_with_null
from millrace.plans import derived
from millrace.plans.catalog import query


@query("flt_compare", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 50000")
def _(t):
    return t.orders.filter(F.col("o_totalprice") < 50000).select("o_orderkey", "o_totalprice")


@query("flt_range_sql", "SELECT p_partkey, p_size FROM part WHERE p_size >= 13 AND p_size <= 19")
def _(t):
    return t.spark.sql("SELECT p_partkey, p_size FROM {part} WHERE p_size >= 13 AND p_size <= 19", part=t.part)


@query("flt_and", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 40 AND l_returnflag = 'R' AND l_discount < 0.03")
def _(t):
    keep = (F.col("l_quantity") > 40) & (F.col("l_returnflag") == "R") & (F.col("l_discount") < 0.03)
    return t.lineitem.filter(keep).select("l_orderkey", "l_linenumber", "l_quantity")


@query("flt_or", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'")
def _(t):
    keep = (F.col("o_orderstatus") == "P") | (F.col("o_orderpriority") == "1-URGENT")
    return t.orders.filter(keep).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("flt_isin", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _(t):
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query(
    "flt_not_equal",
    "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag <> 'N' AND NOT (l_suppkey = l_partkey)",
)
def _(t):
    keep = (F.col("l_returnflag") != "N") & ~(F.col("l_suppkey") == F.col("l_partkey"))
    return t.lineitem.filter(keep).select("l_orderkey", "l_linenumber", "l_returnflag")


@query("flt_expr_string", "SELECT p_partkey, p_size FROM part WHERE p_size < 30")
def _(t):
    return t.part.filter("p_size < 30").select("p_partkey", "p_size")


@query("flt_any_null", f"WITH {derived.LABELLED} SELECT doc_id, lang, quality, toxic FROM labelled WHERE quality IS NULL OR toxic IS NULL OR lang IS NULL")
def _(t):
    return rows_with_null(derived.labelled(t).select("doc_id", "lang", "quality", "toxic"))


@query("flt_sentinel", f"WITH {derived.MARKED} SELECT count(*) AS n FROM marked WHERE priority = '?'")
def _(t):
    return equals_marker(derived.marked_orders(t), "priority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flt_prefix",
    """SELECT event_id, token FROM (SELECT event_id, unnest(['saw', '#' || event_type, 'by', '#user' || (user_id % 10), 'again']) AS token FROM events)
    WHERE token LIKE '#%'""",
)
def _(t):
    post = F.concat_ws(" ", F.lit("saw"), F.concat(F.lit("#"), "event_type"), F.lit("by"), F.concat(F.lit("#user"), (F.col("user_id") % 10).cast("string")), F.lit("again"))
    words = t.events.select("event_id", F.explode(tokens(post)).alias("token"))
    return words.filter(F.col("token").startswith("#"))
