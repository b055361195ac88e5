"""Headline queries at one scale: prints one JSON line with seconds per query.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and
cores. Each query runs once to warm up and is then timed; whole results are produced (a no-op
sink takes them), nothing is collected to Python.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans.catalog import all_queries  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = [
    "src_csv_schema",
    "src_text_parse",
    "proj_interval_bins",
    "proj_row_index",
    "str_tokenize_regex",
    "str_regex_log_parse",
    "flt_and",
    "join_inner_equi",
    "join_left_outer_cond",
    "join_broadcast_lookup",
    "join_group_lists",
    "agg_histogram",
    "agg_sum_by_key",
    "agg_value_share_by_user",
    "agg_value_distribution",
    "agg_quantiles",
    "agg_pearson_pairs",
    "agg_contingency_max",
    "agg_word_count",
    "win_latest_per_key",
    "win_holdout_per_user",
    "win_kfold_contiguous",
    "topk_rows",
    "set_except",
    "cln_winsorize",
    "cln_suspicious_users",
    "sim_item_cosine",
    "sim_item_topk",
    "vector_cosine_topk",
    "stm_running_count",
    "stm_sliding_topk",
    "gr_degree_topk",
    "gr_bfs_levels",
    "ml_minmax_scale",
    "ml_linear_regression",
    "ev_multiclass",
    "ev_binary_areas",
    "ev_map_at_k",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", shuffle_partitions=int(cpus), spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = all_queries()
    seconds = {}
    for key in HEADLINE:
        run(registry[key], spark, sf_dir)
        seconds[key] = round(run(registry[key], spark, sf_dir), 3)
        print(f"{key} {seconds[key]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
