"""Plan-shape guards for the scale properties the design relies on."""

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

import __spark_entry__ as E
from ratings_spark.operators import history, rerank
from ratings_spark.session import shared_dir


def physical(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_topk_limits_before_shuffle(spark):
    p = physical(E.queries()["recent_ratings"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_all_pairs_work_has_no_cartesian(spark):
    for name in ["item_similarity", "user_topk", "rerank_scores", "predict_pairs"]:
        p = physical(E.queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_only_bounded_nested_loop(spark):
    p = physical(E.queries()["genre_top10"](spark, SF_SMALL))
    # the nested loop exists once, with the fixed genre list as its build side
    assert p.count("BroadcastNestedLoopJoin") == 1 and "BuildRight" in p


def test_scans_prune_columns(spark):
    p = physical(E.queries()["rating_counts"](spark, SF_SMALL))
    assert "l_shipdate" not in p and "l_comment" not in p and "o_orderpriority" not in p


def test_hot_user_exact(spark):
    # one user holds a third of all messages
    data = [(0, i % 50, float(1 + i % 5), i, i) for i in range(600)] + \
           [(1 + i % 40, i % 50, float(1 + i % 5), i, 600 + i) for i in range(1200)]
    m = spark.createDataFrame(data, "uid long, mid long, score double, timestamp long, msg_id long") \
        .repartition(6)
    got = rows(rerank.recents_from_messages(m, 20), "uid", "rank", "mid")
    want = []
    for u in {d[0] for d in data}:
        items = sorted((d for d in data if d[0] == u), key=lambda d: (-d[3], -d[4]))[:20]
        want += [(u, k + 1, d[1]) for k, d in enumerate(items)]
    assert got == sorted(want)


def _looked_up(spark, table, uids):
    keys = spark.createDataFrame([(u,) for u in uids], "uid long")
    return history.lookup(keys, [(table, ["uid"], (("uid", "bigint"), ("mid", "bigint")))])[0]


def test_bucketed_table_reads_only_named_buckets(spark):
    path = shared_dir(spark, "test-bucketed")
    base = spark.range(0, 200).select(F.col("id").alias("uid"), (F.col("id") * 2).alias("mid"))
    t = history.BucketedTable(spark, path, "uid")
    assert t.layout() == (None, set()) and _looked_up(spark, t, [5]).count() == 0   # not there yet
    history.write_by_bucket(base, path, "uid", 16)
    ids = history.bucket_id_sets(spark.createDataFrame([(5,), (77,)], "uid long"),
                                 {"uid": ("uid", 16)})["uid"]
    part = _looked_up(spark, t, [5, 77])
    files = part.inputFiles()
    assert files and all(any(f"uid_bucket={i}/" in f for i in ids) for f in files)
    assert {5, 77} <= {r["uid"] for r in part.collect()}
    assert t.read(t.layout(), []) is None and t.read(t.layout(), [999]) is None


def test_rewritten_table_is_read_as_it_is_now(spark):
    """More rows in new buckets, then another number of buckets."""
    path = shared_dir(spark, "test-rewritten")
    base = spark.range(0, 200).select(F.col("id").alias("uid"), (F.col("id") * 2).alias("mid"))
    t = history.BucketedTable(spark, path, "uid")
    for rows_, buckets in ((base.where("uid < 3"), 16), (base, 16), (base, 1024), (base.where("uid < 50"), 4)):
        history.write_by_bucket(rows_, path, "uid", buckets)
        want = {r["uid"] for r in rows_.collect()}
        got = {r["uid"] for r in _looked_up(spark, t, range(200)).collect()}
        assert got == want and t.layout()[0] == buckets


def test_tables_of_different_layouts_are_read_together(spark):
    one, two = shared_dir(spark, "test-one"), shared_dir(spark, "test-two")
    history.write_by_bucket(spark.createDataFrame([(1, 10)], "uid int, mid int"), one, "uid", 16)
    history.write_by_bucket(spark.createDataFrame([(1, 11), (2, 12)], "uid long, mid long"), two, "uid", 64)
    tables = [history.BucketedTable(spark, p, "uid") for p in (one, two)]
    assert rows(_looked_up(spark, tables, [1, 2])) == [(1, 10), (1, 11), (2, 12)]


def test_bucket_number_follows_the_data(spark, monkeypatch):
    assert history.bucket_count(0) == 16 and history.bucket_count(10 ** 9) == 500
    monkeypatch.setattr(history, "BUCKET_ROWS", 10)
    path = shared_dir(spark, "test-count")
    history.write_by_bucket(spark.range(500).withColumnRenamed("id", "uid"), path, "uid")
    assert history.BucketedTable(spark, path, "uid").layout()[0] == 50


def test_lines_are_split_once(spark):
    from ratings_spark.sources import text
    lines = spark.createDataFrame([("a",)], "value string").repartition(1)
    for parse in (text.parse_movies, text.parse_ratings, text.parse_tags, text.parse_messages):
        for frame in parse(lines):
            assert frame._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from ratings_spark import session

    def fake(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda *_: None),
            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None,
                                         setCheckpointDir=lambda _: None))
    assert session.checkpoint_root(fake("local[4]"))
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.checkpoint_root(fake(master))
