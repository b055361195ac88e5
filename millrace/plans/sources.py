"""Sources and sinks: written to the shared folder by Spark and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.logs import log_fields
from millrace.operators import dictionaries
from millrace.operators.aggregates import spread_by_key, value_distribution
from millrace.plans import derived
from millrace.plans.catalog import query
from millrace.sources import delimited, inline, sinks, text
from millrace.storage import scratch_path
from millrace.streaming import counts


def _path(t, label):
    return scratch_path(t.spark, label)


@query("src_csv_schema", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = sinks.write_csv(t.customer, _path(t, "customer"), sep="\t")
    return delimited.read_typed(t.spark, path, t.customer.schema, sep="\t")


@query(
    "src_csv_infer",
    "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def _(t):
    return delimited.read_inferred(t.spark, sinks.write_csv(t.part, _path(t, "part"), header=True))


@query(
    "src_csv_string_cast",
    "SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem",
)
def _(t):
    columns = t.lineitem.select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
    return delimited.cast_all(delimited.read_strings(t.spark, sinks.write_csv(columns, _path(t, "lines"), header=True)))


@query(
    "src_csv_headerless_names",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS price,
    strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority AS priority FROM orders""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderpriority")
    path = sinks.write_csv(rows, _path(t, "orders"))
    return delimited.read_positional(
        t.spark, path, ["order_id", "customer_id", "price", "day", "priority"], ["bigint", "bigint", "double", "string", "string"]
    )


@query("src_csv_trim_ws", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def _(t):
    path = sinks.write_lines(t.customer, _path(t, "blanks"), ["c_custkey", "c_mktsegment", "c_acctbal"], sep=",  ")
    return delimited.read_trimmed(t.spark, path, "c_custkey bigint, c_mktsegment string, c_acctbal double")


@query(
    "src_csv_charset",
    r"""SELECT doc_id, lang, regexp_replace(translate(text, chr(10) || chr(13) || '|"\', '     '), '[^\x00-\xFF]', '?', 'g') AS body
    FROM documents""",
)
def _(t):
    flat = t.documents.select("doc_id", "lang", F.translate("text", '\n\r|"\\', "     ").alias("body"))
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    path = sinks.write_csv(flat, _path(t, "latin1"), sep="|", encoding="ISO-8859-1", **blanks)
    return delimited.read_charset(t.spark, path, "doc_id bigint, lang string, body string")


@query(
    "src_text_lines",
    """SELECT CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""",
)
def _(t):
    path = _path(t, "book")
    t.documents.select("text").write.option("lineSep", "\n").text(path)
    lines = t.spark.read.option("lineSep", "\n").text(path)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


@query(
    "src_text_parse",
    f"""WITH {derived.RATINGS} SELECT 'record' AS kind, item_id, user_id, CAST(rating AS FLOAT) AS rating, ts FROM ratings WHERE rating <> 3
    UNION ALL SELECT 'reject', NULL, NULL, NULL, NULL FROM ratings WHERE rating = 3""",
)
def _(t):
    whole = ["item_id", "user_id", "rating", "ts"]
    line = F.when(F.col("rating") == 3, F.concat_ws("::", *whole[:3])).otherwise(F.concat_ws("::", *whole))
    path = _path(t, "ratings")
    derived.ratings(t).select(line.alias("value")).write.text(path)
    fields = [("item_id", "bigint"), ("user_id", "bigint"), ("rating", "float"), ("ts", "bigint")]
    records, rejects = text.store_parsed(text.read_lines(t.spark, path), _path(t, "parsed"), fields, sep="::")
    return records.select(F.lit("record").alias("kind"), "*").unionByName(
        rejects.select(F.lit("reject").alias("kind")), allowMissingColumns=True
    )


@query("src_text_quoted", "SELECT p_partkey AS id, p_name AS name FROM part WHERE p_size >= 5")
def _(t):
    named = F.concat(F.col("p_partkey").cast("string"), F.lit(' "'), "p_name", F.lit('"'))
    bare = F.concat(F.col("p_partkey").cast("string"), F.lit(" "), "p_name")
    path = _path(t, "names")
    t.part.select(F.when(F.col("p_size") >= 5, named).otherwise(bare).alias("value")).write.text(path)
    return text.parse_quoted(text.read_lines(t.spark, path))


@query(
    "src_inline_rows",
    """SELECT label, CAST(count(*) AS BIGINT) AS n FROM orders
    JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) AS s(code, label) ON o_orderstatus = code GROUP BY label""",
)
def _(t):
    states = inline.inline_rows(t.spark, [("F", "finished"), ("O", "open"), ("P", "partial")], "code string, label string")
    per_code = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    # three literal rows
    return per_code.join(F.broadcast(states), F.col("o_orderstatus") == F.col("code")).select("label", "n")


@query(
    "src_stream_text_dir",
    f"""WITH {derived.LOG_FIELDS} SELECT
    CASE WHEN bad THEN '' ELSE host END AS host, CASE WHEN bad THEN '' ELSE timestamp END AS timestamp,
    CASE WHEN bad THEN '' ELSE method END AS method, CASE WHEN bad THEN '' ELSE endpoint END AS endpoint,
    CASE WHEN bad THEN '' ELSE protocol END AS protocol, CASE WHEN bad THEN NULL ELSE status END AS status,
    CASE WHEN bad THEN NULL ELSE content_size END AS content_size FROM logs""",
)
def _(t):
    lines = counts.watch_text(t.spark, derived.log_folder(t))
    return counts.drain_to_table(lines.select(*log_fields(F.col("value"))), "parsed-logs")


@query("sink_csv_overwrite", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = sinks.write_csv(t.orders.select("o_orderkey"), _path(t, "overwritten"))
    sinks.write_csv(rows, path)
    return delimited.read_typed(t.spark, path, rows.schema)


@query(
    "sink_text_single",
    """SELECT 'o_orderpriority;' || o_orderpriority || ';' || count(*) AS value FROM orders GROUP BY o_orderpriority
    UNION ALL SELECT 'o_orderstatus;' || o_orderstatus || ';' || count(*) FROM orders GROUP BY o_orderstatus""",
)
def _(t):
    report = value_distribution(t.orders, ["o_orderpriority", "o_orderstatus"])
    return text.read_lines(t.spark, sinks.write_lines(report, _path(t, "report"), ["column", "value", "n"], single=True))


@query(
    "sink_lookup_dictionary",
    "SELECT DISTINCT c_name AS name, CAST(c_custkey AS INTEGER) AS code FROM customer JOIN orders ON c_custkey = o_custkey",
)
def _(t):
    used = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("name"), F.col("c_custkey").cast("int").alias("code")
    )
    path = sinks.write_dictionary(used, _path(t, "dictionary"), "name", "code")
    return delimited.read_typed(t.spark, path, "name string, code int")


_FIRST_LOAD = "1995-07-01"
_LOADS = f"""WITH used AS (SELECT c_name AS name, min(CASE WHEN o_orderdate < DATE '{_FIRST_LOAD}' THEN 1 ELSE 2 END) AS load, count(*) AS n
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name)"""


def _loads(t):
    """Names of the customers of orders: of those before a date, and of all."""
    named = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("name"), "o_orderdate")
    return named.filter(F.col("o_orderdate") < F.lit(_FIRST_LOAD).cast("timestamp_ntz")), named


@query("sink_dictionary_grows", f"{_LOADS} SELECT name AS key, row_number() OVER (ORDER BY load, name) - 1 AS code, CAST(load AS INTEGER) AS version FROM used")
def _(t):
    path = _path(t, "growing_dictionary")
    for version, load in enumerate(_loads(t), 1):
        book = dictionaries.grow(load, "name", path, version)
    return book


@query("sink_dictionary_unseen", f"{_LOADS} SELECT name AS key, n FROM used WHERE load = 2")
def _(t):
    first, later = _loads(t)
    return dictionaries.unseen(later, "name", dictionaries.grow(first, "name", _path(t, "first_dictionary"), 1))


@query("sink_stream_table", f"WITH {derived.LOG_FIELDS} SELECT CASE WHEN bad THEN NULL ELSE status END AS status, count(*) AS n FROM logs GROUP BY 1")
def _(t):
    lines = counts.watch_text(t.spark, derived.log_folder(t))
    return counts.drain_complete(counts.status_counts(lines), "status_counts")


@query(
    "sink_summary_table",
    """SELECT user_id, round(coalesce(stddev_samp(value), 0), 4) AS stddev, count(*) AS n FROM events GROUP BY user_id""",
)
def _(t):
    table = spread_by_key(t.events, "user_id", "value").withColumn("stddev", F.round("stddev", 4))
    return t.spark.read.parquet(sinks.write_parquet(table, _path(t, "summary")))
