import math
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import aggregates as agg
from millrace.operators import cleaning, filters, joins, ranking, sampling
from millrace.operators.sets import except_rows

DAY = 86_400


def numbers(spark, n=3000, seed=3):
    """Values with one hot key and one hot value: about a third of the rows each."""
    rng = random.Random(seed)
    data = [(i, "hot" if rng.random() < 0.35 else rng.choice("abcdefgh"), 7 if rng.random() < 0.35 else rng.randrange(500)) for i in range(n)]
    return data, spark.createDataFrame(data, "id int, k string, v int").repartition(5)


def test_positions_match_a_plain_sort(spark):
    data, df = numbers(spark)
    got = {r["id"]: r["position"] for r in ranking.with_position(df, [F.desc("v"), F.col("id")]).collect()}
    expect = sorted(data, key=lambda r: (-r[2], r[0]))
    assert got == {r[0]: i for i, r in enumerate(expect)}


def test_rank_within_matches_row_number_with_null_keys(spark):
    _, df = numbers(spark)
    df = df.withColumn("k", F.when(F.col("k") == "a", None).otherwise(F.col("k")))
    mine = ranking.rank_within(df, ["k"], [F.desc("v"), F.col("id")]).select("id", F.col("rank").cast("int"))
    window = df.select("id", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"), "id")).alias("rank"))
    assert rows(mine) == rows(window)


def test_running_sums_match_a_window(spark):
    _, df = numbers(spark)
    mine = ranking.with_running_sums(df, [F.col("v"), F.col("id")], {"s": F.col("v"), "n": F.lit(1)}).select("id", "s", "n")
    w = Window.orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(mine) == rows(df.select("id", F.sum("v").over(w).alias("s"), F.count("*").over(w).alias("n")))


def test_ntile_matches_the_window_function(spark):
    for n in (3, 5, 23, 100):
        df = spark.range(n).select((F.col("id") * 7 % 101).alias("x"))
        mine = ranking.ntile(df, 5, [F.col("x")])
        assert rows(mine) == rows(df.select("x", F.ntile(5).over(Window.orderBy("x")).alias("tile")))


def test_latest_per_key_breaks_ties(spark):
    df = spark.createDataFrame([(1, 1, 3, 10), (1, 1, 5, 10), (1, 2, 1, 5), (1, 2, 4, 9)], "u int, i int, r int, ts int")
    assert rows(ranking.latest_per_key(df, ["u", "i"], [F.desc("ts"), F.desc("r")])) == [(1, 1, 5, 10), (1, 2, 4, 9)]


def test_top_per_key_is_cut_before_the_shuffle(spark):
    _, df = numbers(spark)
    plan = ranking.top_per_key(df, ["k"], [F.desc("v"), F.col("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(k") < plan.index("Partial")


def test_exact_quantiles(spark):
    data, df = numbers(spark)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = agg.quantiles(df, ["v", "id"], probs)
    for column, at in (("v", 2), ("id", 0)):
        ordered = sorted(r[at] for r in data)
        expect = [float(ordered[max(-(-len(ordered) * int(p * 100) // 100), 1) - 1]) for p in probs]
        assert got[column] == expect
    near = agg.quantiles(df, ["id"], [0.5], error=0.05)["id"][0]
    assert abs(near - 1500) < 200


@pytest.mark.parametrize("n", [1, 7, 640, 1900])
def test_exact_quantiles_on_small_tables(spark, n):
    rng = random.Random(n)
    data = [(rng.choice([rng.gauss(0, 5), 1.5, None]),) for _ in range(n)]
    probs = [0.0, 0.013, 0.25, 0.5, 0.77, 0.999, 1.0]
    ordered = sorted(v for (v,) in data if v is not None)
    got = agg.quantiles(spark.createDataFrame(data, "v double"), ["v"], probs)["v"]
    assert got == [ordered[max(math.ceil(len(ordered) * p), 1) - 1] if ordered else None for p in probs]


def test_mean_exact_and_truncated(spark):
    df = spark.createDataFrame([(33, 385), (33, 2), (40, 7)], "age int, friends int")
    assert rows(agg.mean_by_key(df, "age", "friends")) == [(33, 193.5), (40, 7.0)]
    assert rows(agg.truncated_mean_by_key(df, "age", "friends")) == [(33, 193), (40, 7)]


def test_spread_of_a_single_row_is_zero(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (2, 14)], "u int, ts int")
    got = rows(agg.spread_by_key(df, "u", "ts"))
    assert got[0] == (1, 0.0, 1) and got[1][1] == statistics.stdev([10, 14])


def test_mode_tie_takes_the_smaller_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), (None,), (None,)], "c string")
    assert rows(agg.modes(df, ["c"])) == [("c", "a", 2)]


def test_marker_on_an_integer_column_counts_zero(spark):
    df = spark.createDataFrame([(1, "?"), (2, "x")], "n int, s string")
    assert rows(agg.matches_per_column(df, "?")) == [(0, 1)]
    assert filters.equals_marker(df, "n").count() == 0
    assert filters.equals_marker(df, "s").count() == 1


def test_distributions_match_counters(spark):
    data, df = numbers(spark)
    got = {(r["column"], r["value"]): r["n"] for r in agg.value_distribution(df, ["k", "v"]).collect()}
    expect = Counter([("k", r[1]) for r in data] + [("v", str(r[2])) for r in data])
    assert got == dict(expect)
    distinct = {r["column"]: r["n_distinct"] for r in agg.distinct_counts(df, ["k", "v"]).collect()}
    assert distinct == {"k": len({r[1] for r in data}), "v": len({r[2] for r in data})}


def test_pivot_and_long_contingency_agree(spark):
    _, df = numbers(spark)
    df = df.withColumn("odd", F.when(F.col("v") % 2 == 1, "y").otherwise("n"))
    wide = agg.contingency(df, "k", "odd", ["y", "n", "never"])
    cells = {(r["left_value"], r["right_value"]): r["n"] for r in agg.contingency_long(df, [("k", "odd")]).collect()}
    for r in wide.collect():
        assert (r["y"], r["n"], r["never"], r["other"]) == (cells.get((r["k"], "y"), 0), cells.get((r["k"], "n"), 0), 0, 0)
    assert agg.largest_cells(df, ["k", "odd"]).first()["largest"] == max(cells.values())


def test_grouped_values_keep_every_value(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 3), (2, 4)], "k int, v int")
    assert rows(agg.value_runs(df, "k", "v")) == [(1, 3, 1), (1, 5, 2), (2, 4, 1)]
    assert agg.value_runs(spark.range(10_001).selectExpr("1 AS k", "id AS v"), "k", "v").count() == 10_001


def test_unlisted_categories_are_counted(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "new"), ("a", None), ("b", "x")], "k string, c string")
    assert rows(agg.contingency(df, "k", "c", ["x", "y"])) == [("a", 1, 0, 2), ("b", 1, 0, 0)]


def test_joined_distinct_fills_as_many_rows_as_it_needs(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    assert rows(agg.joined_distinct(df, "c")) == [(0, "a, b")]
    many = agg.joined_distinct(spark.range(10_001).select(F.format_string("%06d", "id").alias("c")), "c", sep=" ")
    got = rows(many)
    assert len(got) == 20 and " ".join(r[1] for r in got).split() == [f"{i:06d}" for i in range(10_001)]


def test_pair_correlations_agree_with_the_matrix(spark):
    _, df = numbers(spark)
    pairs = {(r["a"], r["b"]): r["r"] for r in agg.pearson_pairs(df, ["id", "v"]).collect()}
    full = {(r["a"], r["b"]): r["r"] for r in agg.pearson_pairs(df, ["id", "v"], full=True).collect()}
    assert full[("id", "v")] == full[("v", "id")] == pairs[("id", "v")] == round(df.corr("id", "v"), 6)
    assert full[("v", "v")] == 1.0


def test_lookup_forms_agree_and_keep_missing_ids(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (9, 30)], "k int, n int")
    names = spark.createDataFrame([(1, "one"), (2, "two")], "id int, name string")
    joined = rows(joins.lookup(facts, names, "k", "id", ["name"]))
    assert joined == [(1, 10, "one"), (2, 20, "two"), (9, 30, None)]
    assert rows(joins.lookup_by_udf(facts, names, "k", "id", "name", "name")) == joined


def test_left_outer_condition_keeps_all_rows(spark):
    left = spark.createDataFrame([(1, "en"), (2, "fr"), (3, "en")], "id int, lang string")
    right = spark.createDataFrame([(1, 7), (2, 8)], "id int, q int")
    assert rows(joins.left_outer_where(left, right, "id", F.col("lang") == "en")) == [(1, "en", 7), (2, "fr", None), (3, "en", None)]


def suspicious(spark):
    start = 1_000_000_000
    burst = [("burst", i % 5 + 1, start + i) for i in range(51)]
    alike = [("alike", 5 if i < 47 else 1, start + i * 40 * DAY) for i in range(51)]
    short = [("short", i % 5 + 1, start + i) for i in range(50)]
    fair = [("fair", i % 5 + 1, start + i * 40 * DAY) for i in range(60)]
    data = [(u, i, r, ts) for i, (u, r, ts) in enumerate(burst + alike + short + fair)]
    return spark.createDataFrame(data, "user_id string, item_id int, rating int, ts bigint")


def test_suspicious_users(spark):
    df = suspicious(spark)
    assert {r["user_id"] for r in cleaning.suspicious_users(df).collect()} == {"burst", "alike"}
    kept = cleaning.drop_suspicious(df)
    assert {r["user_id"]: r["count"] for r in kept.groupBy("user_id").count().collect()} == {"short": 50, "fair": 60}
    flagged = cleaning.suspicious_users(df)
    assert joins.exclude(df, flagged, "user_id").count() == kept.count()


def test_fill_mean_cuts_integers(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 2.0), (None, None)], "i int, d double")
    filled = cleaning.fill_mean(df, ["i", "d"])
    assert (1, round(5 / 3, 6)) in [(r[0], round(r[1], 6)) for r in filled.collect()]


def test_marker_to_mode(spark):
    df = spark.createDataFrame([("?", "x"), ("?", "y"), ("a", "?"), ("?", "y")], "p string, q string")
    assert rows(cleaning.marker_to_mode(df, ["p", "q"])) == [("a", "x"), ("a", "y"), ("a", "y"), ("a", "y")]


def test_outliers_and_winsorizing(spark):
    df = spark.createDataFrame([(v,) for v in list(range(1, 21)) + [1000, -1000, None]], "v int")
    assert rows(cleaning.drop_iqr_outliers(df, ["v"])) == [(v,) for v in range(1, 21)]
    clipped = [r[0] for r in cleaning.winsorize(df, ["v"], 0.1, 0.9).collect()]
    assert min(v for v in clipped if v is not None) == 2.0 and max(v for v in clipped if v is not None) == 19.0
    assert clipped.count(None) == 1


def test_hash_split_covers_everything_once(spark):
    df = sampling.hash_split(spark.range(10_000), ["id"], [0.5, 0.3, 0.2])
    sizes = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 10_000
    assert all(abs(sizes[i] - w) < 300 for i, w in enumerate((5000, 3000, 2000)))
    again = sampling.hash_split(spark.range(10_000).repartition(7), ["id"], [0.5, 0.3, 0.2])
    assert df.exceptAll(again).count() == 0


def test_random_split_covers_everything_once(spark):
    parts = sampling.random_split(spark.range(1000), [0.7, 0.3], seed=1)
    assert rows(parts[0].union(parts[1])) == [(i,) for i in range(1000)]


def test_stratified_samples(spark):
    df = spark.range(9000).select("id", (F.col("id") % 3).alias("s"))
    for kept in (sampling.stratified(df, "s", {0: 1.0, 1: 0.5}, 1), sampling.stratified_by_hash(df, "s", {0: 1.0, 1: 0.5}, ["id"])):
        sizes = {r["s"]: r["count"] for r in kept.groupBy("s").count().collect()}
        assert sizes[0] == 3000 and abs(sizes[1] - 1500) < 150 and 2 not in sizes


def test_holdout_and_folds(spark):
    data = [(u, i, i * 10) for u, n in ((1, 30), (2, 5), (3, 500)) for i in range(n)]
    df = spark.createDataFrame(data, "u int, i int, ts int")
    base, test = sampling.holdout_per_key(df, "u", ["u", "i"], [F.col("ts")], 2, 10)
    assert rows(test) == sorted((u, i, ts) for u, i, ts in data if 1 <= i <= 9)
    assert rows(base.union(test)) == sorted(data)
    folds = sampling.contiguous_folds(df, 5, [F.col("u"), F.col("i")])
    sizes = {r["fold"]: r["count"] for r in folds.groupBy("fold").count().collect()}
    assert sizes == {1: 107, 2: 107, 3: 107, 4: 107, 5: 107}
    spans = folds.groupBy("fold").agg(F.min(F.struct("u", "i")).alias("lo"), F.max(F.struct("u", "i")).alias("hi")).orderBy("fold").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


def test_except_removes_duplicates(spark):
    all_rows = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert rows(except_rows(all_rows, spark.createDataFrame([(2,), (2,)], "x int"))) == [(1,)]


def test_except_is_one_aggregation_and_keeps_nulls(spark):
    left = spark.createDataFrame([(1, None), (1, None), (None, "b"), (2, "c"), (3, None)], "`a.b` int, y string")
    taken = spark.createDataFrame([(None, "b"), (2, "c"), (3, "z"), (9, "c")], "p int, q string")
    got = except_rows(left, taken)
    assert got.columns == ["a.b", "y"] and rows(got) == [(1, None), (3, None)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1


def test_except_query_deals_pairs_out_by_measured_rows(spark):
    from millrace.plans.catalog import all_queries

    plan = all_queries()["set_except"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
