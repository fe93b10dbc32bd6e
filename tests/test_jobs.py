"""The public jobs end to end on sf0.001, through text files and parquet."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from ratings_spark.operators import similarity
from ratings_spark.plans import jobs
from ratings_spark.session import shared_dir
from ratings_spark.sources import adapters as A
from ratings_spark.streaming import rerank_stream as RS


def test_jobs_end_to_end(spark):
    base = shared_dir(spark, "test-jobs")
    d = SF_SMALL
    r = A.ratings(spark, d)
    A.movie_lines(A.movies(spark, d)).write.text(f"{base}/in/movies")
    lines = A.rating_lines(r).unionByName(spark.createDataFrame([("bad,line",)], "value string"))
    lines.write.text(f"{base}/in/ratings")
    A.tag_lines(A.tags(spark, d)).write.text(f"{base}/in/tags")

    T = {n: jobs.in_folder(f"{base}/out", n) for n in [
        "movies", "ratings", "tags", "search_docs", "movies_rejects", "ratings_rejects",
        "tags_rejects", "rating_counts", "monthly_counts", "average_scores", "genre_top",
        "user_recs", "item_recs", "grid", "rated"]}
    rej = jobs.load(spark, f"{base}/in/movies", f"{base}/in/ratings", f"{base}/in/tags", T)
    assert rej == {"movies": 0, "ratings": 1, "tags": 0}
    assert T["ratings"].read(spark).count() == r.count()
    docs = T["search_docs"].read(spark)
    assert docs.count() == docs.select("mid").distinct().count() == A.movies(spark, d).count()

    jobs.statistics(spark, T["ratings"], T["movies"], T, genres=["PROMO", "ring"])
    gt = T["genre_top"].read(spark).collect()
    assert {g["genres"] for g in gt} == {"PROMO", "ring"} and all(len(g["recs"]) <= 10 for g in gt)
    assert T["rating_counts"].read(spark).agg(F.sum("count")).first()[0] == r.count()

    jobs.offline(spark, T["ratings"], T["movies"], T, rank=8, max_iter=3, threshold=0.6)
    ur = T["user_recs"].read(spark)
    assert ur.where(F.size("recs") > 10).count() == 0 and ur.count() > 0
    ir = T["item_recs"].read(spark)
    assert "mid_bucket" in ir.columns and ir.where("sim <= 0.6").count() == 0

    g = jobs.grid(spark, T["ratings"], T["grid"], ranks=[4], regs=[0.1, 1.0], max_iter=2)
    assert g.count() == 2

    jobs.rated_index(spark, T["ratings"], T["rated"])
    msgs = A.messages(spark, d)
    A.message_lines(msgs).write.text(f"{base}/in/messages")
    q = jobs.realtime(spark, RS.message_stream(spark, "text", f"{base}/in/messages"),
                      T["item_recs"], T["rated"], f"{base}/stream", f"{base}/ckpt",
                      trigger={"availableNow": True}, threshold=0.6)
    q.awaitTermination()
    assert q.exception() is None
    latest = RS.latest_recs(spark, f"{base}/stream")
    assert latest.count() == msgs.select("uid").distinct().count()


def test_edges_from_nested(spark):
    n = spark.createDataFrame([(1, [(2, 0.7), (3, 0.9), (2, 0.8)])],
                              "mid long, recs array<struct<mid:bigint,r:double>>")
    e = sorted(tuple(x) for x in similarity.edges_from_nested(n).collect())
    assert e == [(1, 2, 0.8), (1, 3, 0.9)]
