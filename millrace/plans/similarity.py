"""Similarity and recommendation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.ml import als_search, recommend
from millrace.operators.joins import lookup
from millrace.operators.overlap import similar_pairs
from millrace.operators.similarity import item_cosine, nearest_vectors, similar_items
from millrace.plans import derived
from millrace.plans.catalog import query
from millrace.storage import materialize


@query(
    "sim_item_cosine",
    f"""WITH {derived.RATINGS} SELECT a.item_id AS item1, b.item_id AS item2,
    round(sum(a.rating * b.rating) / (sqrt(sum(a.rating * a.rating)) * sqrt(sum(b.rating * b.rating))), 6) AS score, count(*) AS n_pairs
    FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2 HAVING count(*) >= 3""",
)
def _(t):
    return item_cosine(derived.ratings(t), min_pairs=3)


@query(
    "sim_item_threshold",
    f"""WITH {derived.RATINGS} SELECT * FROM (SELECT a.item_id AS item1, b.item_id AS item2,
      round(sum(a.rating * b.rating) / (sqrt(sum(a.rating * a.rating)) * sqrt(sum(b.rating * b.rating))), 6) AS score, count(*) AS n_pairs
      FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2) WHERE n_pairs >= 3 AND score > 0.9""",
)
def _(t):
    return similar_pairs(derived.ratings(t), min_score=0.9, min_pairs=3)


@query(
    "sim_item_topk",
    f"""WITH {derived.RATINGS} SELECT item_id, round(xy / (sqrt(xx) * sqrt(yy)), 6) AS score, n_pairs, p_name AS name FROM (
      SELECT b.item_id, sum(a.rating * b.rating) AS xy, sum(a.rating * a.rating) AS xx, sum(b.rating * b.rating) AS yy, count(*) AS n_pairs
      FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id <> b.item_id WHERE a.item_id = 0 GROUP BY 1)
    JOIN part ON p_partkey = item_id WHERE round(xy / (sqrt(xx) * sqrt(yy)), 6) > 0.9 AND n_pairs >= 2
    ORDER BY score DESC, n_pairs DESC, item_id LIMIT 10""",
)
def _(t):
    return similar_items(derived.stored_ratings(t), derived.item_names(t), item=0, k=10, min_score=0.9, min_pairs=2)


@query(
    "vector_cosine_topk",
    """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), q AS (SELECT v AS w FROM e WHERE vec_id = 0)
    SELECT vec_id, round(list_inner_product(v, w) / (sqrt(list_inner_product(v, v)) * sqrt(list_inner_product(w, w))), 6) AS score
    FROM e, q ORDER BY score DESC, vec_id LIMIT 10""",
)
def _(t):
    return nearest_vectors(t.embeddings, "vec_id", "embedding", 0, k=10)


def _als_rows(t):
    """Ratings under dense ids, and the two dictionaries."""
    r = derived.stored_ratings(t)
    users, items = recommend.dense_ids(r, "user_id"), recommend.dense_ids(r, "item_id")
    return materialize(recommend.with_dense_ids(r, users, items), "als_ratings"), users, items


def _als(rows):
    return recommend.fit_als(rows, rank=10, iterations=10, reg=0.1)


@query(
    "rec_als_fit_predict",
    f"WITH {derived.RATINGS} SELECT count(*) AS n_rows, count(DISTINCT (user_id, item_id)) AS n_pairs, round(avg(rating), 6) AS mean_rating, true AS beats_mean, true AS all_scored FROM ratings",
)
def _(t):
    rows, _, _ = _als_rows(t)
    scored = materialize(_als(rows).transform(rows), "scored")
    return scored.join(F.broadcast(rows.agg(F.avg("rating").alias("mean"), F.count(F.lit(1)).alias("all")))).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_id", "item_id").alias("n_pairs"), F.round(F.avg("rating"), 6).alias("mean_rating"),
        (F.avg((F.col("rating") - F.col("prediction")) ** 2) < F.avg((F.col("rating") - F.col("mean")) ** 2)).alias("beats_mean"),
        (F.count_if(F.isnan("prediction") | F.col("prediction").isNull()) == 0).alias("all_scored"),
    )


_GRID = [(rank, reg) for rank in (5, 10) for reg in (0.05, 0.2)]


@query(
    "sel_als_grid",
    f"""WITH {derived.RATINGS}, numbered AS (SELECT dense_rank() OVER (ORDER BY user_id) - 1 AS u, dense_rank() OVER (ORDER BY item_id) - 1 AS i FROM ratings),
    folded AS (SELECT u, i, CAST(('0x' || substr(md5('fold|' || u || '|' || i), 1, 8)) AS BIGINT) >= 2147483648 AS fold FROM numbered),
    known AS (SELECT u, i, (u, fold) IN (SELECT (u, NOT fold) FROM folded) AND (i, fold) IN (SELECT (i, NOT fold) FROM folded) AS k FROM folded)
    SELECT CAST(rank AS INTEGER) AS rank, CAST(reg AS DOUBLE) AS reg, count(*) FILTER (k) AS n_scored, count(*) FILTER (NOT k) AS n_dropped, true AS chosen_is_least, true AS one_chosen
    FROM known, (VALUES {", ".join(map(str, _GRID))}) g(rank, reg) GROUP BY ALL""",
)
def _(t):
    """A grid over rank and regularisation under two folds; rows of users or items that a fold does not know are counted."""
    rows, _, _ = _als_rows(t)
    _, _, table = als_search.search(rows, _GRID, folds=2, iterations=5)
    found = table.agg(F.min("rmse").alias("least"), F.count_if("chosen").alias("n_chosen"))
    return table.join(F.broadcast(found)).select(
        "rank", "reg", "n_scored", "n_dropped", (~F.col("chosen") | (F.col("rmse") == F.col("least"))).alias("chosen_is_least"), (F.col("n_chosen") == 1).alias("one_chosen")
    )


def _named(t, recs, users, items):
    """Recommendations under the original ids."""
    back = recs.join(users.withColumnsRenamed({"user_id": "user", "id": "_uid"}), F.col("user_id") == F.col("_uid"))
    back = back.join(items.withColumnsRenamed({"item_id": "item", "id": "_iid"}), F.col("item_id") == F.col("_iid"))
    return back.select(F.col("user").alias("user_id"), F.col("item").alias("item_id"), "rank", "score")


def _recommended(t, by, only=None):
    """``only``: users (or items) to recommend for, by their own ids in column ``only``."""
    rows, users, items = _als_rows(t)
    chosen = None
    if only is not None:
        chosen = materialize((users if by == "user_id" else items).join(only, F.col(by) == F.col("only")).select("id"), "chosen")
    best = recommend.top_items(_als(rows), 10, chosen) if by == "user_id" else recommend.top_users(_als(rows), 10, chosen)
    return _named(t, best, users, items)


@query("rec_topk")
def _(t):
    return lookup(_recommended(t, "user_id"), derived.item_names(t), "item_id", "id", ["name"])


@query("rec_topk_users")
def _(t):
    return _recommended(t, "item_id")


@query("rec_topk_user_subset")
def _(t):
    """For the customers of one market segment."""
    return _recommended(t, "user_id", t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("only")))


@query("rec_topk_item_subset")
def _(t):
    """For the large parts."""
    return _recommended(t, "item_id", t.part.filter("p_size > 40").select(F.col("p_partkey").alias("only")))


@query("rec_factor_similarity", f"WITH {derived.RATINGS} SELECT least(11, count(DISTINCT item_id)) AS n_items, true AS itself_first, true AS ordered FROM ratings")
def _(t):
    rows, _, _ = _als_rows(t)
    near = recommend.similar_factors(_als(rows), 0, k=11)
    ranked = near.agg(F.count(F.lit(1)).alias("n_items"), F.max_by("id", "score").alias("first"), F.max("score").alias("top"), F.min("score").alias("low"))
    return ranked.select("n_items", ((F.col("first") == 0) & (F.abs(F.col("top") - 1) < 1e-6)).alias("itself_first"), (F.col("low") <= F.col("top")).alias("ordered"))
