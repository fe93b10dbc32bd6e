"""Catalogue entries: factor scoring, similarity, ALS."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratings_spark.operators import als, factors, history, similarity, stats
from ratings_spark.constants import ALS_GRID_RANKS, ALS_GRID_REGS
from ratings_spark.plans.catalogue import FACTORS_SQL, MOVIES_SQL, RATINGS_SQL, query, r6, with_
from ratings_spark.session import materialize
from ratings_spark.sources import adapters as A

ITEM_SIM_THRESHOLD = 0.4   # the embeddings' cosines stay below 0.6 (max ~0.51)


@query("predict_pairs", with_(r=RATINGS_SQL, f=FACTORS_SQL) + """
, p AS (SELECT DISTINCT uid, mid FROM r)
SELECT p.uid, p.mid, round(list_inner_product(u.features, i.features), 6) AS prediction
FROM p JOIN f u ON p.uid = u.id JOIN f i ON p.mid = i.id""")
def q_predict_pairs(spark: SparkSession, d: str) -> DataFrame:
    f = A.factors(spark, d)
    pairs = history.distinct_pairs(A.ratings(spark, d))
    return factors.predict_pairs(pairs, f, f).select("uid", "mid", r6("prediction").alias("prediction"))


@query("user_topk", with_(f=FACTORS_SQL, m=MOVIES_SQL) + """
, items AS (SELECT * FROM f WHERE id IN (SELECT mid FROM m))
, s AS (SELECT u.id AS uid, i.id AS mid, list_inner_product(u.features, i.features) AS score
        FROM f u CROSS JOIN items i)
, x AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS rn
        FROM s WHERE score > 0)
SELECT uid, CAST(rn AS INTEGER) AS rank, mid, round(score, 6) AS score FROM x WHERE rn <= 10""")
def q_user_topk(spark: SparkSession, d: str) -> DataFrame:
    f = A.factors(spark, d)
    catalogue_items = f.join(A.movies(spark, d).select(F.col("mid").alias("id")), "id", "left_semi")
    out = factors.top_k_items(f, catalogue_items, k=10, positive_only=True)
    return out.select("uid", "rank", "mid", r6("score").alias("score"))


_SIM_EDGES_SQL = """
  SELECT a.id AS mid, b.id AS other_mid, list_cosine_similarity(a.features, b.features) AS sim
  FROM f a JOIN f b ON a.id <> b.id
  WHERE list_cosine_similarity(a.features, b.features) > {t}"""


@query("item_similarity", with_(f=FACTORS_SQL, e=_SIM_EDGES_SQL.format(t=ITEM_SIM_THRESHOLD)) +
       "SELECT mid, other_mid, round(sim, 6) AS sim FROM e")
def q_item_similarity(spark: SparkSession, d: str) -> DataFrame:
    e = similarity.item_similarity(A.factors(spark, d), ITEM_SIM_THRESHOLD)
    return e.select("mid", "other_mid", r6("sim").alias("sim"))


@query("item_neighbours", with_(f=FACTORS_SQL, e=_SIM_EDGES_SQL.format(t=ITEM_SIM_THRESHOLD)) + """
SELECT mid, count(*) AS n_neighbours, round(min(sim), 6) AS min_sim, round(max(sim), 6) AS max_sim
FROM e GROUP BY mid""")
def q_item_neighbours(spark: SparkSession, d: str) -> DataFrame:
    e = similarity.item_similarity(A.factors(spark, d), ITEM_SIM_THRESHOLD)
    s = similarity.neighbour_stats(e)
    return s.select("mid", "n_neighbours", r6("min_sim").alias("min_sim"),
                    r6("max_sim").alias("max_sim"))


@query("item_neighbours_top5", with_(f=FACTORS_SQL, e=_SIM_EDGES_SQL.format(t=0.3)) + """
, x AS (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY sim DESC, other_mid) AS rn FROM e)
SELECT mid, CAST(rn AS INTEGER) AS rank, other_mid, round(sim, 6) AS sim FROM x WHERE rn <= 5""")
def q_item_neighbours_top5(spark: SparkSession, d: str) -> DataFrame:
    e = similarity.item_similarity(A.factors(spark, d), 0.3)
    return similarity.neighbour_lists(e, 5).select("mid", "rank", "other_mid", r6("sim").alias("sim"))


@query("rmse", with_(r=RATINGS_SQL) + """
, a AS (SELECT mid, avg(score) AS prediction FROM r GROUP BY mid)
SELECT round(sqrt(avg((r.score - a.prediction) * (r.score - a.prediction))), 6) AS rmse,
       count(*) AS n
FROM r JOIN a ON r.mid = a.mid""")
def q_rmse(spark: SparkSession, d: str) -> DataFrame:
    """RMSE with each item's mean score as the prediction for every pair."""
    r = A.ratings(spark, d)
    preds = history.distinct_pairs(r).join(
        stats.average_scores(r).withColumnRenamed("avg", "prediction"), "mid")
    return als.rmse(r, preds).select(r6("rmse").alias("rmse"), "n")


# --- model fitting (random initialisation: no SQL oracle) -------------------------

def _model(spark: SparkSession, d: str, rank: int = 50):
    return als.fit(A.ratings(spark, d), rank=rank, max_iter=5, reg=0.01, seed=42)


@query("als_user_recs")
def q_als_user_recs(spark: SparkSession, d: str) -> DataFrame:
    m = _model(spark, d)
    return als.user_recs(m, 10, catalogue=A.movies(spark, d)) \
        .select("uid", "rank", "mid", r6("score").alias("score"))


@query("als_item_recs")
def q_als_item_recs(spark: SparkSession, d: str) -> DataFrame:
    m = _model(spark, d)
    return als.item_recs(m, 0.6).select("mid", "other_mid", r6("sim").alias("sim"))


@query("als_rmse")
def q_als_rmse(spark: SparkSession, d: str) -> DataFrame:
    r = A.ratings(spark, d)
    return als.model_rmse(_model(spark, d), r).select(r6("rmse").alias("rmse"), "n")


@query("als_grid", with_(r=RATINGS_SQL) + f"""
, p AS (SELECT unnest({ALS_GRID_RANKS}) AS rank),
  g AS (SELECT unnest({ALS_GRID_REGS}::DOUBLE[]) AS reg_param)
SELECT CAST(rank AS INTEGER) AS rank, reg_param, (SELECT count(*) FROM r) AS n,
       CAST(1 AS BIGINT) AS n_best, TRUE AS best_is_least FROM p, g""")
def q_als_grid(spark: SparkSession, d: str) -> DataFrame:
    """The whole rank x lambda search by training-set RMSE: each point with the
    ratings it scored, the number of best points and whether the best is least."""
    g = als.grid(A.ratings(spark, d), mode="train", parallelism=4)
    best = g.agg(F.count_if("best").alias("n_best"),
                 (F.min("rmse") == F.min(F.when(F.col("best"), F.col("rmse")))).alias("best_is_least"))
    return g.join(best).select("rank", "reg_param", "n", "n_best", "best_is_least")


# --- properties that any fitted model must have (computed from the fit) -------------

@query("als_normal_equations", with_(r=RATINGS_SQL) + """
SELECT uid, count(*) AS n, TRUE AS solved FROM r GROUP BY uid""")
def q_als_normal_equations(spark: SparkSession, d: str) -> DataFrame:
    r = A.ratings(spark, d)
    x = als.normal_equations(_model(spark, d), r, reg=0.01)
    return x.select(F.col("uid").cast("long"), "n", (F.col("residual") < 1e-3).alias("solved"))


@query("als_topk_agreement", with_(r=RATINGS_SQL) + """
SELECT uid, CAST(0 AS BIGINT) AS mismatches FROM r GROUP BY uid""")
def q_als_topk_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Blocked top 10 over the whole catalogue against Spark ML's own, rank by
    rank (scores within float tolerance, as ties may swap items)."""
    r, m = A.ratings(spark, d), _model(spark, d)
    mine = als.user_recs(m, 10, catalogue=A.movies(spark, d)).select("uid", "rank", "score")
    theirs = als.user_recs(m, 10).select("uid", "rank", F.col("score").alias("other"))
    far = F.abs(F.col("score") - F.col("other")) > 1e-4
    off = mine.join(theirs, ["uid", "rank"], "full") \
        .groupBy("uid").agg(F.count_if(F.coalesce(far, F.lit(True))).alias("bad"))
    users = r.select(F.col("uid").cast("long").alias("uid")).distinct()
    return users.join(off, "uid", "left").select("uid", F.coalesce("bad", F.lit(0)).alias("mismatches"))


@query("als_edge_faults", "SELECT TRUE AS has_edges, CAST(0 AS BIGINT) AS wrong, "
                          "CAST(0 AS BIGINT) AS unmirrored")
def q_als_edge_faults(spark: SparkSession, d: str) -> DataFrame:
    m = _model(spark, d)
    edges = materialize(als.item_recs(m, 0.6), "als_edges")
    return als.edge_faults(m, edges).select((F.col("edges") > 0).alias("has_edges"), "wrong", "unmirrored")


@query("als_beats_mean", with_(r=RATINGS_SQL) + "SELECT count(*) AS n, TRUE AS better FROM r")
def q_als_beats_mean(spark: SparkSession, d: str) -> DataFrame:
    """Training RMSE below that of predicting the global mean."""
    r = A.ratings(spark, d)
    mean = r.agg(F.stddev_pop("score").alias("spread"))
    return als.model_rmse(_model(spark, d), r).join(mean) \
        .select("n", (F.col("rmse") < F.col("spread")).alias("better"))


@query("user_topk_unrated", with_(f=FACTORS_SQL, m=MOVIES_SQL, r=RATINGS_SQL) + """
, items AS (SELECT * FROM f WHERE id IN (SELECT mid FROM m))
, s AS (SELECT u.id AS uid, i.id AS mid, list_inner_product(u.features, i.features) AS score
        FROM f u CROSS JOIN items i
        WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.uid = u.id AND r.mid = i.id))
, x AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS rn
        FROM s WHERE score > 0)
SELECT uid, CAST(rn AS INTEGER) AS rank, mid, round(score, 6) AS score FROM x WHERE rn <= 10""")
def q_user_topk_unrated(spark: SparkSession, d: str) -> DataFrame:
    f = A.factors(spark, d)
    catalogue_items = f.join(A.movies(spark, d).select(F.col("mid").alias("id")), "id", "left_semi")
    out = factors.top_k_items(f, catalogue_items, k=10, exclude=A.ratings(spark, d))
    return out.select("uid", "rank", "mid", r6("score").alias("score"))


@query("neighbour_lists_nested", with_(f=FACTORS_SQL, e=_SIM_EDGES_SQL.format(t=0.3)) + """
, x AS (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY sim DESC, other_mid) AS rn FROM e)
SELECT mid, other_mid, round(sim, 6) AS sim FROM x WHERE rn <= 5""")
def q_neighbour_lists_nested(spark: SparkSession, d: str) -> DataFrame:
    """Top-5 neighbour lists nested per item (the stored list form), then
    flattened back to lookup edges."""
    from ratings_spark.operators.topk import nest_ranked
    e = similarity.item_similarity(A.factors(spark, d), 0.3)
    nested = nest_ranked(similarity.neighbour_lists(e, 5), ["mid"], "rank",
                         {"mid": "other_mid", "r": "sim"})
    return similarity.edges_from_nested(nested).select("mid", "other_mid", r6("sim").alias("sim"))
