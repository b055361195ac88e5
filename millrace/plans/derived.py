"""Inputs derived from the tables, once as DataFrames and once as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import epoch_seconds
from millrace.ml.evaluate import ranked_predictions
from millrace.operators.graph import lines_from_edges
from millrace.operators.ranking import latest_per_key
from millrace.session import Tables
from millrace.storage import materialize, scratch_path

# --- ratings: a customer rates a part by the quantity ordered -------------------------------


def raw_ratings(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    heads = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.pmod(F.col("l_quantity").cast("int"), F.lit(5)) + 1).alias("rating"),
        epoch_seconds(F.col("o_orderdate")).alias("ts"),
    )


def newest(raw: DataFrame) -> DataFrame:
    return latest_per_key(raw, ["user_id", "item_id"], [F.desc("ts"), F.desc("rating")])


def ratings(t: Tables) -> DataFrame:
    return newest(raw_ratings(t))


def stored_ratings(t: Tables) -> DataFrame:
    """The ratings written once, for queries that read them more than once."""
    return materialize(ratings(t), "ratings")


def item_names(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


RATINGS = """raw_ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(CAST(l_quantity AS INTEGER) % 5 + 1 AS INTEGER) AS rating, CAST(epoch(o_orderdate) AS BIGINT) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ratings AS (
  SELECT user_id, item_id, rating, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, rating DESC) AS rn FROM raw_ratings)
  WHERE rn = 1)"""

# --- ranked lists: each user's items by the item's mean rating; liked items are the truth ----


def lists(t: Tables, depth: int = 10) -> tuple[DataFrame, DataFrame]:
    """(ranked, liked): the ``depth`` best own items per user by mean rating, and the items rated 4 or 5."""
    r = stored_ratings(t)
    means = materialize(r.groupBy("item_id").agg(F.round(F.avg("rating"), 6).alias("score")), "means")
    ranked = ranked_predictions(r.join(means, "item_id"), "score", depth)
    return ranked, r.filter("rating >= 4").select("user_id", "item_id")


def ranked_sql(depth: int) -> str:
    return (
        RATINGS
        + f""",
scored AS (SELECT user_id, item_id, rating, round(avg(rating) OVER (PARTITION BY item_id), 6) AS score FROM ratings),
ranked AS (SELECT * FROM (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM scored)
  WHERE rank <= {depth}),
liked AS (SELECT user_id, item_id FROM ratings WHERE rating >= 4)"""
    )


RANKED = ranked_sql(10)

# --- readings: event values as tenths of a degree ---------------------------------------------


def readings(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("station"),
        F.col("event_type").alias("kind"),
        (F.col("value") * 10).cast("int").alias("tenths"),
    )


READINGS = "readings AS (SELECT user_id AS station, event_type AS kind, CAST(trunc(value * 10) AS INTEGER) AS tenths FROM events)"

# --- logs: access-log lines; error events become lines that do not parse ----------------------


def log_lines(t: Tables) -> DataFrame:
    uid = F.col("user_id")
    host = F.concat_ws(".", F.lit("10.0"), F.floor(uid / 256).cast("string"), (uid % 256).cast("string"))
    when = F.concat(F.lit("["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000]"))
    request = F.concat(
        F.lit('"'), F.when(F.col("event_type") == "purchase", "POST").otherwise("GET"), F.lit(" /"), "event_type", F.lit(' HTTP/1.1"')
    )
    status = F.when(F.col("value") < 5, "404").when(F.col("value") < 10, "301").otherwise("200")
    size = (F.col("value") * 100).cast("int").cast("string")
    line = F.concat_ws(" ", host, F.lit("- -"), when, request, status, size)
    garbled = F.concat(F.lit("garbled-"), F.col("event_id").cast("string"))
    return t.events.select(F.when(F.col("event_type") == "error", garbled).otherwise(line).alias("value"))


def log_folder(t: Tables) -> str:
    """The log lines as text files in the shared folder."""
    path = scratch_path(t.spark, "logs")
    log_lines(t).write.text(path)
    return path


LOG_FIELDS = """logs AS (
  SELECT event_type = 'error' AS bad,
    '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS host,
    strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000' AS timestamp,
    CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
    '/' || event_type AS endpoint, 'HTTP/1.1' AS protocol,
    CASE WHEN value < 5 THEN 404 WHEN value < 10 THEN 301 ELSE 200 END AS status,
    CAST(trunc(value * 100) AS INTEGER) AS content_size, date_trunc('second', ts) AS seen_at
  FROM events)"""

# --- graph: parts (even ids) and the customers who ordered them (odd ids), both directions ----


def graph_edges(t: Tables) -> DataFrame:
    pairs = raw_ratings(t).select("user_id", "item_id").distinct()
    item, user = F.col("item_id") * 2, F.col("user_id") * 2 + 1
    ends = F.array(F.struct(item.alias("src"), user.alias("dst")), F.struct(user.alias("src"), item.alias("dst")))
    return pairs.select(F.explode(ends).alias("e")).select("e.src", "e.dst")


def graph_names(t: Tables) -> DataFrame:
    parts = t.part.select((F.col("p_partkey") * 2).alias("id"), F.col("p_name").alias("name"))
    people = t.customer.filter("c_acctbal >= 0").select((F.col("c_custkey") * 2 + 1).alias("id"), F.col("c_name").alias("name"))
    return parts.union(people)


def graph_lines(t: Tables) -> DataFrame:
    """Adjacency lines ``id neighbour ...``; a vertex fills one line per 512 possible neighbours."""
    return lines_from_edges(graph_edges(t))


GRAPH = """pairs AS (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
edges AS (SELECT l_partkey * 2 AS src, o_custkey * 2 + 1 AS dst FROM pairs
  UNION ALL SELECT o_custkey * 2 + 1, l_partkey * 2 FROM pairs),
names AS (SELECT p_partkey * 2 AS id, p_name AS name FROM part
  UNION ALL SELECT c_custkey * 2 + 1, c_name FROM customer WHERE c_acctbal >= 0)"""

# --- marker and null inputs -------------------------------------------------------------------


def marked_orders(t: Tables, *extra: str) -> DataFrame:
    """Orders whose status and priority hold a missing-value marker on some rows."""
    return t.orders.select(
        *extra,
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("o_totalprice") > 400000, "?").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_totalprice") < 20000, "?").otherwise(F.col("o_orderstatus")).alias("status"),
    )


MARKED = """marked AS (SELECT o_orderkey, o_totalprice,
    CASE WHEN o_totalprice > 400000 THEN '?' ELSE o_orderpriority END AS priority,
    CASE WHEN o_totalprice < 20000 THEN '?' ELSE o_orderstatus END AS status FROM orders)"""


def labelled(t: Tables) -> DataFrame:
    """Documents with their labels; most have none, so quality and toxic are often null."""
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left")


LABELLED = "labelled AS (SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"

# --- deterministic scores and predictions for the metrics -------------------------------------


def predicted_prices(t: Tables) -> DataFrame:
    """Line price against a fixed linear guess from the quantity."""
    return t.lineitem.select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500.0).alias("prediction"))


PREDICTED = "predicted AS (SELECT l_extendedprice AS label, l_quantity * 1500.0::DOUBLE AS prediction FROM lineitem)"


def predicted_classes(t: Tables) -> DataFrame:
    """Three return-flag classes against a fixed guess from quantity and discount."""
    label = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    guess = F.when(F.col("l_quantity") > 30, 1.0).when(F.col("l_discount") > 0.05, 2.0).otherwise(0.0)
    return t.lineitem.select(label.alias("label"), guess.alias("prediction"))


CLASSES = """classes AS (SELECT
    CASE l_returnflag WHEN 'A' THEN 0.0::DOUBLE WHEN 'N' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS label,
    CASE WHEN l_quantity > 30 THEN 1.0::DOUBLE WHEN l_discount > 0.05 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM lineitem)"""


def scored_lines(t: Tables) -> DataFrame:
    """A binary label (finished line) against a fixed score."""
    return t.lineitem.select(
        F.round(F.col("l_discount") * 10 + F.col("l_tax"), 4).alias("score"),
        F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("label"),
    )


SCORED = """scored AS (SELECT round(l_discount * 10 + l_tax, 4) AS score,
    CASE WHEN l_linestatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM lineitem)"""
