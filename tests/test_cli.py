"""The command line runs the batch jobs end to end (in-process)."""

from conftest import SF_SMALL

from ratings_spark.__main__ import main
from ratings_spark.session import shared_dir
from ratings_spark.sources import adapters as A


def test_cli_batch_jobs(spark):
    base = shared_dir(spark, "test-cli")
    A.movie_lines(A.movies(spark, SF_SMALL)).write.text(f"{base}/in/m")
    A.rating_lines(A.ratings(spark, SF_SMALL)).write.text(f"{base}/in/r")
    A.tag_lines(A.tags(spark, SF_SMALL)).write.text(f"{base}/in/t")
    out = f"{base}/out"
    main(["load", "--out", out, "--movies-text", f"{base}/in/m", "--ratings-text", f"{base}/in/r",
          "--tags-text", f"{base}/in/t"])
    main(["statistics", "--out", out, "--genres", "PROMO,ring"])
    main(["offline", "--out", out, "--rank", "4", "--iterations", "2"])
    for t in ["movies", "ratings", "tags", "search_docs", "rated", "rating_counts",
              "monthly_counts", "average_scores", "genre_top", "user_recs", "item_recs"]:
        assert spark.read.parquet(f"{out}/{t}").count() > 0, t
    msgs = A.messages(spark, SF_SMALL)
    A.message_lines(msgs).write.text(f"{base}/in/msg")
    main(["realtime", "--out", out, "--messages", f"{base}/in/msg", "--available-now"])
    from ratings_spark.streaming import rerank_stream as RS
    n_users = msgs.select("uid").distinct().count()
    assert RS.latest_recs(spark, f"{out}/stream_recs").count() == n_users
    main(["compact", "--out", out])
    assert RS.latest_recs(spark, f"{out}/stream_recs").count() == n_users
