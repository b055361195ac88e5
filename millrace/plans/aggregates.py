"""Aggregations and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as fc
from millrace.functions.strings import words
from millrace.operators import aggregates as agg
from millrace.operators.profile import schema_profile
from millrace.operators.sketches import merge_sketches, quantile_sketches, sketched_quantiles
from millrace.plans import derived
from millrace.plans.catalog import query
from millrace.session import TABLES
from millrace.storage import materialize


@query("agg_count_rows", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def _(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(t.lineitem.columns)).alias("n_columns"))


@query("agg_histogram", f"WITH {derived.RATINGS} SELECT rating, count(*) AS n FROM ratings GROUP BY rating")
def _(t):
    return agg.histogram(derived.ratings(t), "rating").orderBy("rating")


@query("agg_avg_by_key", "SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean FROM customer GROUP BY c_mktsegment")
def _(t):
    return agg.mean_by_key(t.customer, "c_mktsegment", "c_acctbal", digits=4).orderBy("c_mktsegment")


@query(
    "agg_avg_int_truncated",
    f"WITH {derived.RATINGS} SELECT item_id, CAST(sum(rating) AS BIGINT) // count(*) AS mean FROM ratings GROUP BY item_id",
)
def _(t):
    return agg.truncated_mean_by_key(derived.ratings(t), "item_id", "rating")


def _extreme(t, kind, best, name):
    kept = derived.readings(t).filter(F.col("kind") == kind)
    per_station = kept.groupBy("station").agg(best("tenths").alias("tenths"))
    return per_station.select("station", fc.tenths_celsius_to_fahrenheit(F.col("tenths")).alias(name))


@query(
    "agg_min_by_key",
    f"WITH {derived.READINGS} SELECT station, round(min(tenths) * 0.1::DOUBLE * (9.0::DOUBLE / 5.0) + 32.0, 2) AS low FROM readings WHERE kind = 'view' GROUP BY station",
)
def _(t):
    return _extreme(t, "view", F.min, "low")


@query(
    "agg_max_by_key",
    f"WITH {derived.READINGS} SELECT station, round(max(tenths) * 0.1::DOUBLE * (9.0::DOUBLE / 5.0) + 32.0, 2) AS high FROM readings WHERE kind = 'click' GROUP BY station",
)
def _(t):
    return _extreme(t, "click", F.max, "high")


@query("agg_sum_by_key", "SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey")
def _(t):
    totals = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return totals.orderBy(F.desc("total"), "o_custkey")


@query(
    "agg_stddev_by_user",
    "SELECT user_id, round(coalesce(stddev_samp(epoch_us(ts) // 1000000), 0), 2) AS stddev, count(*) AS n FROM events GROUP BY user_id",
)
def _(t):
    timed = t.events.select("user_id", fc.epoch_seconds(F.col("ts")).alias("at"))
    return agg.spread_by_key(timed, "user_id", "at").withColumn("stddev", F.round("stddev", 2))


@query(
    "agg_value_share_by_user",
    f"WITH {derived.RATINGS} SELECT user_id, "
    + ", ".join(f"round(avg(CASE WHEN rating = {v} THEN 100.0::DOUBLE ELSE 0 END), 2) AS share_{v}" for v in range(6))
    + ", count(*) AS n FROM ratings GROUP BY user_id",
)
def _(t):
    return agg.value_shares_by_key(derived.ratings(t), "user_id", "rating", range(6))


@query(
    "agg_mean_by_period",
    """SELECT 'month' AS period, CAST(month(ts) AS INTEGER) AS at, round(avg(value), 4) AS mean FROM events GROUP BY 2
    UNION ALL SELECT 'hour', CAST(hour(ts) AS INTEGER), round(avg(value), 4) FROM events GROUP BY 2""",
)
def _(t):
    both = F.array(
        F.struct(F.lit("month").alias("period"), F.month("ts").alias("at")),
        F.struct(F.lit("hour").alias("period"), F.hour("ts").alias("at")),
    )
    spread = t.events.select("value", F.explode(both).alias("p"))
    return spread.groupBy("p.period", "p.at").agg(F.round(F.avg("value"), 4).alias("mean"))


@query("agg_count_popularity", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10")
def _(t):
    return agg.histogram(t.lineitem, "l_partkey").orderBy(F.desc("n"), "l_partkey").limit(10)


@query(
    "agg_multi_conditional",
    """SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 4) AS mean_quantity, max(l_extendedprice) AS top_price,
    round(avg(CASE WHEN l_discount > 0.05 THEN l_extendedprice END), 2) AS discounted_mean FROM lineitem GROUP BY l_returnflag""",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("l_quantity"), 4).alias("mean_quantity"),
        F.max("l_extendedprice").alias("top_price"),
        F.round(F.avg(F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice"))), 2).alias("discounted_mean"),
    )


@query(
    "agg_conditional_percent",
    "SELECT round(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 4) AS pct FROM orders WHERE o_totalprice < 250000",
)
def _(t):
    cheap = t.orders.filter("o_totalprice < 250000")
    return cheap.agg(fc.percent(F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)), F.count(F.lit(1)), 4).alias("pct"))


@query(
    "agg_conditional_sum_ranked",
    "SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished FROM orders WHERE o_totalprice > 100000 GROUP BY 1",
)
def _(t):
    finished = F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("finished")
    kept = t.orders.filter(F.col("o_totalprice") > 100000)
    return kept.groupBy("o_orderpriority").agg(finished).orderBy(F.desc("finished"), "o_orderpriority")


@query("agg_multi_key_count", "SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2, 3")
def _(t):
    keys = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return agg.histogram(t.lineitem, keys).orderBy(*keys)


@query("agg_global_minmax", "SELECT CAST(min(epoch_us(ts) // 1000000) AS BIGINT) AS first, CAST(max(epoch_us(ts) // 1000000) AS BIGINT) AS last FROM events")
def _(t):
    at = fc.epoch_seconds(F.col("ts"))
    return t.events.agg(F.min(at).alias("first"), F.max(at).alias("last"))


@query("agg_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def _(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "agg_count_distinct",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM orders"
        for c in ("o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    ),
)
def _(t):
    return agg.distinct_counts(t.orders, ["o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"])


_DOC_COLUMNS = ("doc_id", "lang", "source", "n_chars", "quality", "toxic")


@query(
    "agg_nulls_per_column",
    f"WITH {derived.LABELLED} SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in _DOC_COLUMNS) + " FROM labelled",
)
def _(t):
    return agg.nulls_per_column(derived.labelled(t), _DOC_COLUMNS)


@query(
    "agg_sentinel_per_column",
    f"""WITH {derived.MARKED} SELECT 0::BIGINT AS o_orderkey, 0::BIGINT AS o_totalprice, count(*) FILTER (priority = '?') AS priority,
    count(*) FILTER (status = '?') AS status FROM marked""",
)
def _(t):
    return agg.matches_per_column(derived.marked_orders(t), "?")


@query(
    "agg_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
        CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")
    ),
)
def _(t):
    return agg.summary(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"])


@query(
    "agg_value_distribution",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM orders GROUP BY {c}"
        for c in ("o_orderstatus", "o_orderpriority", "o_custkey")
    ),
)
def _(t):
    return agg.value_distribution(t.orders, ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query(
    "agg_mode",
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS mode, count(*) AS n FROM orders GROUP BY {c} ORDER BY n DESC, mode LIMIT 1)"
        for c in ("o_orderstatus", "o_orderpriority", "o_custkey")
    ),
)
def _(t):
    return agg.modes(t.orders, ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query(
    "agg_quantiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS prob, CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM {tab}"
        for tab, c in (("part", "p_retailprice"), ("part", "p_size"))
        for p in (0.05, 0.25, 0.5, 0.75, 0.95)
    ),
)
def _(t):
    return agg.exact_quantiles(t.part, ["p_retailprice", "p_size"], [0.05, 0.25, 0.5, 0.75, 0.95])


@query(
    "agg_pivot_contingency",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P,
      count(*) FILTER (coalesce(o_orderstatus NOT IN ('F', 'O', 'P'), true)) AS other FROM orders GROUP BY 1""",
)
def _(t):
    return agg.contingency(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


_FLAG_STATUS = [f"{f}_{s}" for f in "ANR" for s in "FO"]


@query(
    "agg_crosstab",
    "SELECT l_linenumber, "
    + ", ".join(f"count(*) FILTER (l_returnflag || '_' || l_linestatus = '{v}') AS {v}" for v in _FLAG_STATUS)
    + f", count(*) FILTER (coalesce(l_returnflag || '_' || l_linestatus NOT IN ({', '.join(repr(v) for v in _FLAG_STATUS)}), true)) AS other"
    + " FROM lineitem GROUP BY l_linenumber",
)
def _(t):
    keyed = t.lineitem.select("l_linenumber", F.concat_ws("_", "l_returnflag", "l_linestatus").alias("flag_status"))
    return agg.contingency(keyed, "l_linenumber", "flag_status", _FLAG_STATUS)


@query(
    "agg_contingency_max",
    " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", max(n) AS largest FROM (SELECT count(*) AS n FROM lineitem GROUP BY {a}, {b})"
        for a, b in (("l_returnflag", "l_linestatus"), ("l_returnflag", "l_linenumber"), ("l_linestatus", "l_linenumber"))
    ),
)
def _(t):
    return agg.largest_cells(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"])


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "agg_pearson_pairs",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for i, a in enumerate(_NUMERIC) for b in _NUMERIC[i + 1 :]
    ),
)
def _(t):
    return agg.pearson_pairs(t.lineitem, _NUMERIC)


@query(
    "agg_corr_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in _NUMERIC for b in _NUMERIC),
)
def _(t):
    return agg.pearson_pairs(t.lineitem, _NUMERIC, full=True)


@query(
    "agg_frequency_table",
    "SELECT CAST(floor(p_size / 5.0) * 5 AS BIGINT) AS bucket, p_type, count(*) AS n FROM part GROUP BY 1, 2",
)
def _(t):
    bucketed = t.part.select(fc.floor_bucket(F.col("p_size"), 5).alias("bucket"), "p_type")
    return agg.histogram(bucketed, ["bucket", "p_type"]).orderBy("bucket", "p_type")


@query(
    "agg_two_pass_percent",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM lineitem), 4) AS pct FROM lineitem GROUP BY 1, 2",
)
def _(t):
    return agg.share_of_total(t.lineitem, ["l_returnflag", "l_linestatus"])


@query(
    "agg_top_mean_key",
    "SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1 ORDER BY mean DESC, 1 LIMIT 1",
)
def _(t):
    means = agg.mean_by_key(t.orders, "o_orderpriority", "o_totalprice", digits=4)
    return means.orderBy(F.desc("mean"), "o_orderpriority").limit(1)


@query(
    "agg_collect_group",
    f"WITH {derived.RATINGS} SELECT item_id, rating, count(*) AS n FROM ratings GROUP BY 1, 2",
)
def _(t):
    return agg.value_runs(derived.ratings(t), "item_id", "rating")


@query("agg_sql_avg_group", "SELECT p_brand, round(avg(p_retailprice), 4) AS mean FROM part GROUP BY p_brand")
def _(t):
    return t.spark.sql("SELECT p_brand, round(avg(p_retailprice), 4) AS mean FROM {part} GROUP BY p_brand", part=t.part)


@query("agg_global_mean", "SELECT round(avg(c_acctbal), 4) AS mean FROM customer")
def _(t):
    return t.customer.agg(F.round(F.avg("c_acctbal"), 4).alias("mean"))


@query(
    "agg_word_count",
    r"SELECT token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS token FROM documents) WHERE token <> '' GROUP BY token",
)
def _(t):
    tokens = t.documents.select(F.explode(words(F.lower("text"))).alias("token"))
    return agg.histogram(tokens, "token").orderBy(F.desc("n"), "token")


# The declared columns and types of the tables, for the oracle of the schema profile.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


@query(
    "prof_schema",
    " UNION ALL ".join(
        f"SELECT '{tab}' AS table_name, '{c.split()[0]}' AS column_name, '{c.split()[1]}' AS data_type, count({c.split()[0]}) AS n_present, count(*) AS n_rows FROM {tab}"
        for tab, spec in _SCHEMAS.items()
        for c in spec.split(", ")
    ),
)
def _(t):
    return schema_profile({name: getattr(t, name) for name in TABLES})


@query(
    "agg_quantile_sketch",
    """SELECT l_returnflag, l_linestatus, share, count(*) AS n, true AS within
    FROM lineitem, (SELECT unnest([0.05::DOUBLE, 0.5::DOUBLE, 0.95::DOUBLE]) AS share) GROUP BY 1, 2, 3""",
)
def _(t):
    """Sketches per flag, status and supplier are stored, then merged per flag and status; ranks are counted to prove them."""
    keys = ["l_returnflag", "l_linestatus"]
    stored = materialize(quantile_sketches(t.lineitem, [*keys, "l_suppkey"], "l_extendedprice"), "sketches")
    read = materialize(sketched_quantiles(merge_sketches(stored, keys), keys, [0.05, 0.5, 0.95]), "sketched")
    price = F.col("l_extendedprice").cast("double")
    # Six groups by three shares.
    ranks = t.lineitem.join(F.broadcast(read), keys).groupBy(*keys, "share", "n").agg(
        F.count_if(price < F.col("value")).alias("below"), F.count_if(price <= F.col("value")).alias("upto")
    )
    within = (F.col("below") - 0.01 * F.col("n") <= F.col("share") * F.col("n")) & (F.col("upto") + 0.01 * F.col("n") >= F.col("share") * F.col("n"))
    return ranks.select(*keys, "share", "n", within.alias("within"))
