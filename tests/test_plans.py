"""Physical plans: pushed filters, pruned columns, and nothing that funnels rows into one task."""

import re

import pytest

from conftest import SF
from millrace.plans.catalog import all_queries

QUERIES = all_queries()

# Joined with one aggregated row, which is no pairing of rows with rows.
ONE_ROW_SIDES = {"rec_als_fit_predict"}

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if not k.startswith(("ml_", "sel_", "mdl_")) and k not in ONE_ROW_SIDES))
def test_no_pairing_without_a_key(spark, key):
    plan = plan_of(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    for line in plan.splitlines():
        window = re.search(r"Window \[.*?\], \[(.*?)\]", line)
        if window and "row_number" not in line:
            assert "_part" in line or "user_id" in line, line


@pytest.mark.parametrize(
    "key, pushed, columns",
    [
        ("flt_compare", "LessThan(o_totalprice,50000.0)", "o_orderkey:bigint,o_totalprice:double"),
        ("flt_range_sql", "GreaterThanOrEqual(p_size,13)", "p_partkey:bigint,p_size:int"),
        ("flt_isin", "In(o_orderpriority", "o_orderkey:bigint,o_orderpriority:string"),
        ("flt_and", "EqualTo(l_returnflag,R)", "l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_discount:double,l_returnflag:string"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, key, pushed, columns):
    df = QUERIES[key](spark, SF)
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert pushed in text
    assert f"ReadSchema: struct<{columns}>" in text


def test_unused_columns_are_not_read(spark):
    df = QUERIES["agg_value_distribution"](spark, SF)
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_orderpriority:string>" in text


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.files.maxPartitionBytes": "256k",
    "spark.sql.files.openCostInBytes": "0",
}


@pytest.fixture
def skewed_settings(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["item_mean_predictions", "exclude", "drop_suspicious"])
def test_a_key_with_half_of_the_rows_is_split(spark, skewed_settings, name):
    from pyspark.sql import functions as F

    from millrace.ml.recommend import item_mean_predictions
    from millrace.operators.cleaning import drop_suspicious
    from millrace.operators.joins import exclude
    from millrace.storage import materialize

    hot = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 1000)
    rows = materialize(spark.range(400_000).select(hot.alias("user_id"), hot.alias("item_id"), (F.col("id") % 5).alias("rating"), F.xxhash64("id").alias("ts")), "hot")
    df = {
        "item_mean_predictions": lambda: item_mean_predictions(rows),
        "exclude": lambda: exclude(rows, rows.filter("user_id > 500"), "user_id"),
        "drop_suspicious": lambda: drop_suspicious(rows, min_rows=500, max_stddev=0.0, max_share=10.0),
    }[name]()
    whole = df.agg(F.max(F.xxhash64(*df.columns)))
    whole.collect()
    text = whole._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in text, text


def test_graph_lines_keep_no_object_for_a_list(spark):
    for key in ("gr_build_edges", "gr_most_connected", "arr_explode", "arr_head_tail_size"):
        assert "ObjectHashAggregate" not in plan_of(QUERIES[key](spark, SF)), key


def test_a_hub_is_split_for_its_names(spark, skewed_settings):
    from pyspark.sql import functions as F

    from millrace.operators.graph import edges_from_lines, lines_from_edges, named_edges

    hub = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 1000)
    lines = lines_from_edges(spark.range(400_000).select(hub.alias("src"), F.col("id").alias("dst")))
    names = spark.range(1000).select("id", F.col("id").cast("string").alias("name"))
    whole = named_edges(edges_from_lines(lines), names).agg(F.max(F.xxhash64("src", "dst", "src_name", "dst_name")))
    whole.collect()
    text = whole._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in text, text
