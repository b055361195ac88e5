"""Projections, scalar functions and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as fc
from millrace.functions import strings as fs
from millrace.functions.logs import log_fields
from millrace.ml.features import bin_columns
from millrace.operators.aggregates import joined_distinct
from millrace.operators.ranking import with_position
from millrace.plans import derived
from millrace.plans.catalog import query


@query("proj_select", "SELECT c_custkey, c_name FROM customer")
def _(t):
    return t.customer.select("c_custkey", "c_name")


@query(
    "proj_arith",
    "SELECT o_orderkey, round(o_totalprice + 10, 2) AS plus_ten, round(o_totalprice * 0.21, 4) AS share, 65 - o_orderkey AS left_over FROM orders",
)
def _(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.round(price + 10, 2).alias("plus_ten"),
        F.round(price * 0.21, 4).alias("share"),
        (65 - F.col("o_orderkey")).alias("left_over"),
    )


@query("proj_rename", "SELECT o_orderkey AS order_id, o_totalprice AS price FROM orders")
def _(t):
    renamed = t.orders.withColumnsRenamed({"o_orderkey": "order_id", "o_totalprice": "price"})
    return renamed.select("order_id", "price")


@query("proj_drop", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem")
def _(t):
    return t.lineitem.drop("l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query(
    "proj_cast",
    """SELECT CAST(l_orderkey AS INTEGER) AS order_id, CAST(l_linenumber AS DOUBLE) AS line, CAST(trunc(l_quantity) AS INTEGER) AS quantity,
    CAST(l_linenumber AS VARCHAR) AS line_text, TRY_CAST(l_returnflag AS INTEGER) AS not_a_number FROM lineitem""",
)
def _(t):
    return t.lineitem.select(
        F.col("l_orderkey").cast("int").alias("order_id"),
        F.col("l_linenumber").cast("double").alias("line"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_linenumber").cast("string").alias("line_text"),
        F.col("l_returnflag").try_cast("int").alias("not_a_number"),
    )


@query(
    "proj_null_or_empty_default",
    r"""SELECT event_id, CASE WHEN event_type IN ('view', 'error') THEN 0.0::DOUBLE
    ELSE CAST(regexp_extract(props, '(\d+)', 1) AS DOUBLE) END AS k FROM events""",
)
def _(t):
    found = F.get_json_object("props", "$.k")
    holed = F.when(F.col("event_type") == "view", None).when(F.col("event_type") == "error", "").otherwise(found)
    return t.events.select("event_id", fc.null_or_empty_default(holed, "double").alias("k"))


@query(
    "proj_unit_convert",
    f"WITH {derived.READINGS} SELECT station, kind, round(tenths * 0.1::DOUBLE * (9.0::DOUBLE / 5.0) + 32.0, 2) AS fahrenheit FROM readings",
)
def _(t):
    return derived.readings(t).select("station", "kind", fc.tenths_celsius_to_fahrenheit(F.col("tenths")).alias("fahrenheit"))


@query("proj_when_label", "SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' ELSE 'low' END AS level FROM orders")
def _(t):
    return t.orders.select("o_orderkey", fc.threshold_label(F.col("o_totalprice"), 300000).alias("level"))


@query(
    "proj_interval_bins",
    """SELECT CASE WHEN l_quantity BETWEEN 0 AND 10 THEN 'tiny' WHEN l_quantity BETWEEN 10 AND 20 THEN 'small'
      WHEN l_quantity BETWEEN 20 AND 40 THEN 'medium' ELSE 'Out' END AS l_quantity_bin,
    CASE WHEN l_extendedprice BETWEEN 0 AND 25000 THEN '0-25000' WHEN l_extendedprice BETWEEN 25000 AND 50000 THEN '25000-50000'
      WHEN l_extendedprice BETWEEN 50000 AND 100000 THEN '50000-100000' ELSE 'Out' END AS l_extendedprice_bin,
    CASE WHEN l_discount BETWEEN 0.01 AND 0.03 THEN '0.01-0.03' WHEN l_discount BETWEEN 0.03 AND 0.06 THEN '0.03-0.06'
      ELSE 'l_discount' END AS l_discount_bin, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
)
def _(t):
    edges = {"l_quantity": [0, 10, 20, 40], "l_extendedprice": [0, 25000, 50000, 100000], "l_discount": [0.01, 0.03, 0.06]}
    binned = bin_columns(t.lineitem, edges, {"l_quantity": ["tiny", "small", "medium"]}, {"l_discount": "l_discount"})
    return binned.groupBy("l_quantity_bin", "l_extendedprice_bin", "l_discount_bin").agg(F.count(F.lit(1)).alias("n"))


@query("proj_floor_bucket", "SELECT p_partkey, CAST(floor(p_size / 5.0) * 5 AS BIGINT) AS size_5, CAST(floor(p_size / 10.0) * 10 AS BIGINT) AS size_10 FROM part")
def _(t):
    size = F.col("p_size")
    return t.part.select("p_partkey", fc.floor_bucket(size, 5).alias("size_5"), fc.floor_bucket(size, 10).alias("size_10"))


@query(
    "proj_row_index",
    "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS row_index FROM orders",
)
def _(t):
    dated = t.orders.select("o_orderkey", "o_orderdate")
    return with_position(dated, [F.col("o_orderdate"), F.col("o_orderkey")], "row_index").select("o_orderkey", "row_index")


@query(
    "proj_format_percent",
    "SELECT user_id, round(count(*) FILTER (event_type = 'purchase') * 100.0::DOUBLE / count(*), 2) AS purchase_pct FROM events GROUP BY user_id",
)
def _(t):
    share = fc.percent(F.count_if(F.col("event_type") == "purchase"), F.count(F.lit(1)))
    return t.events.groupBy("user_id").agg(share.alias("purchase_pct"))


@query("proj_epoch_to_text", "SELECT event_id, strftime(ts, '%d-%m-%Y %I:%M') AS at FROM events")
def _(t):
    return t.events.select("event_id", fc.epoch_to_text(fc.epoch_seconds(F.col("ts"))).alias("at"))


@query("str_case", "SELECT p_partkey, lower(p_brand) AS low, upper(p_name) AS up FROM part")
def _(t):
    return t.part.select("p_partkey", F.lower("p_brand").alias("low"), F.upper("p_name").alias("up"))


@query(
    "str_tokenize_space",
    "SELECT doc_id, token FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents) WHERE token <> ''",
)
def _(t):
    return t.documents.select("doc_id", F.explode(fs.tokens(F.col("text"))).alias("token"))


@query(
    "str_tokenize_regex",
    r"SELECT doc_id, token FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\W+')) AS token FROM documents) WHERE token <> ''",
)
def _(t):
    return t.documents.select("doc_id", F.explode(fs.words(F.col("text"))).alias("token"))


@query(
    "arr_head_tail_size",
    f"""WITH {derived.GRAPH} SELECT src AS id, CAST(count(*) AS INTEGER) AS n, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS neighbours
    FROM edges GROUP BY src, dst // 512""",
)
def _(t):
    line = F.col("value")
    near = fs.adjacency_neighbours(line)
    return derived.graph_lines(t).select(fs.adjacency_id(line).alias("id"), F.size(near).alias("n"), F.array_join(near, ",").alias("neighbours"))


@query("arr_explode", f"WITH {derived.GRAPH} SELECT src, dst FROM edges")
def _(t):
    line = F.col("value")
    return derived.graph_lines(t).select(fs.adjacency_id(line).alias("src"), F.explode(fs.adjacency_neighbours(line)).alias("dst"))


@query(
    "str_regex_log_parse",
    f"""WITH {derived.LOG_FIELDS} SELECT
    CASE WHEN bad THEN '' ELSE host END AS host, CASE WHEN bad THEN '' ELSE timestamp END AS timestamp,
    CASE WHEN bad THEN '' ELSE method END AS method, CASE WHEN bad THEN '' ELSE endpoint END AS endpoint,
    CASE WHEN bad THEN '' ELSE protocol END AS protocol, CASE WHEN bad THEN NULL ELSE status END AS status,
    CASE WHEN bad THEN NULL ELSE content_size END AS content_size FROM logs""",
)
def _(t):
    return derived.log_lines(t).select(*log_fields(F.col("value")))


@query("str_regex_capture", r"SELECT c_custkey, CAST(regexp_extract(c_name, '#(\d+)', 1) AS INTEGER) AS number FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.regexp_extract("c_name", r".*#(\d+)", 1).try_cast("int").alias("number"))


@query(
    "str_join_distinct",
    """WITH v AS (SELECT DISTINCT o_orderpriority AS v FROM orders WHERE o_orderpriority IS NOT NULL), p AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS place FROM v)
    SELECT CAST(place // 512 AS BIGINT) AS block, string_agg(v, ', ' ORDER BY v) AS vals FROM p GROUP BY 1""",
)
def _(t):
    return joined_distinct(t.orders, "o_orderpriority")


@query("str_reverse", "SELECT p_partkey, reverse(p_name) AS backwards FROM part")
def _(t):
    return t.part.select("p_partkey", F.reverse("p_name").alias("backwards"))


@query("proj_pair_columns", "SELECT o_orderkey, o_totalprice AS first, o_orderstatus AS second FROM orders")
def _(t):
    pair = F.struct(F.col("o_totalprice").alias("first"), F.col("o_orderstatus").alias("second"))
    return t.orders.select("o_orderkey", pair.alias("pair")).select("o_orderkey", "pair.first", "pair.second")
