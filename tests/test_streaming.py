"""Stream = batch, restart from checkpoint, replayed input."""


from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from ratings_spark.operators import history, rerank, similarity
from ratings_spark.session import shared_dir
from ratings_spark.sources import adapters as A
from ratings_spark.streaming import rerank_stream as RS


def test_stream_equals_batch_across_restarts(spark):
    d = SF_SMALL
    base = shared_dir(spark, "test-stream")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/ckpt"
    msgs = A.messages(spark, d)
    lines = A.message_lines(msgs, keep=["msg_id"])
    edges = lambda: similarity.item_similarity(A.factors(spark, d), 0.3)
    rated = lambda: history.distinct_pairs(A.ratings(spark, d))          # noqa: E731

    def run():
        q = RS.start(RS.message_stream(spark, "text", src, max_files_per_trigger=1), out, ckpt,
                     edges, rated, trigger={"availableNow": True}, threshold=0.3)
        q.awaitTermination()
        assert q.exception() is None

    # two arrivals: newer half first, older half second (late data)
    cut = msgs.approxQuantile("msg_id", [0.5], 0.0)[0]
    lines.where(F.col("msg_id") > cut).select("value").repartition(2).write.text(src)
    run()
    lines.where(F.col("msg_id") <= cut).select("value").repartition(2).write.mode("append").text(src)
    run()
    run()   # nothing new: no new batch, no duplicates

    got = RS.latest_recents(spark, out)
    want = rerank.recents_from_messages(msgs, 20)
    assert rows(got) == rows(want)
    # the final re-rank per user is for the user's latest *processed* message;
    # with late data that message is from the first arrival, so compare with
    # the batch answer computed for those triggers.
    batches = spark.read.parquet(f"{out}/recs")
    assert batches.select("batch_id").distinct().count() >= 2
    assert batches.groupBy("uid", "batch_id").count().where("count > 1").count() == 0

    # compaction: same current view before and after, from the snapshot on
    before = rows(RS.latest_recs(spark, out), "uid", "recs_text", "batch_id")
    through = RS.compact(spark, out, "recs")
    RS.compact(spark, out, "recents")
    assert rows(RS.latest_recs(spark, out), "uid", "recs_text", "batch_id") == before
    assert rows(RS.latest_recents(spark, out)) == rows(want)
    # a later arrival still supersedes the snapshot
    lines.where(F.col("msg_id") == F.lit(cut)).select("value").write.mode("append").text(src)
    run()
    assert spark.read.parquet(f"{out}/recs").agg(F.max("batch_id")).first()[0] > through


def test_stream_in_order_equals_batch_rerank(spark):
    from ratings_spark.plans import stream_queries
    from ratings_spark.plans.realtime_queries import RERANK_SIM
    d = SF_SMALL
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = stream_queries.run_stream(spark, d)
    # the query ran with its own state partitions; the session is unchanged
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    got = RS.latest_recs(spark, out).select("uid", F.explode("recs").alias("x")) \
        .select("uid", F.col("x.mid").alias("mid"), F.round("x.r", 6).alias("score"))
    msgs = A.messages(spark, d)
    edges = similarity.item_similarity(A.factors(spark, d), RERANK_SIM)
    want = rerank.rerank(msgs, edges, history.distinct_pairs(A.ratings(spark, d)),
                         threshold=RERANK_SIM).select("uid", "mid", F.round("score", 6).alias("score"))
    assert rows(got) == rows(want)


def test_exclude_incoming_and_ratings_sink(spark):
    d = SF_SMALL
    base = shared_dir(spark, "test-stream-excl")
    src = f"{base}/src"
    msgs = A.messages(spark, d)
    A.message_lines(msgs).write.text(src)
    edges_path = f"{base}/edges"
    history.write_by_bucket(similarity.item_similarity(A.factors(spark, d), 0.3), edges_path, "mid", 64)
    hist = history.distinct_pairs(A.ratings(spark, d))
    history.write_by_bucket(hist, f"{base}/rated", "uid", 32)

    # streamed ratings land in a user-bucketed table; rated = history + stream
    rated = [history.BucketedTable(spark, f"{base}/{t}", "uid") for t in ("rated", "sink")]
    pairs = (("uid", "bigint"), ("mid", "bigint"))
    assert history.lookup(msgs, [(rated, ["uid"], pairs)])[0].count() <= hist.count()   # no sink yet
    s = RS.ratings_sink(RS.message_stream(spark, "text", src), f"{base}/sink", f"{base}/ck1",
                        trigger={"availableNow": True})
    s.awaitTermination()
    assert spark.read.parquet(f"{base}/sink").count() == msgs.count()
    both = history.lookup(hist.select("uid").unionByName(msgs.select("uid")), [(rated, ["uid"], pairs)])[0]
    assert both.count() == hist.count() + msgs.count()

    q = RS.start(RS.message_stream(spark, "text", src), f"{base}/out", f"{base}/ck2",
                 lambda: spark.read.parquet(edges_path), lambda: hist,
                 trigger={"availableNow": True}, threshold=0.3, include_incoming=False)
    q.awaitTermination()
    assert q.exception() is None
    got = RS.latest_recs(spark, f"{base}/out").select("uid", F.explode("recs").alias("x")) \
        .select("uid", F.col("x.mid").alias("mid"), F.round("x.r", 6).alias("score"))
    want = rerank.rerank(msgs, spark.read.parquet(edges_path), hist, threshold=0.3,
                         include_incoming=False) \
        .select("uid", "mid", F.round("score", 6).alias("score"))
    assert rows(got) == rows(want)
    assert rows(RS.latest_recents(spark, f"{base}/out")) == rows(rerank.recents_from_messages(msgs, 20))


def _recs(spark, base, out, edges, rated, include, **kw):
    q = RS.start(RS.message_stream(spark, "text", f"{base}/src"), f"{base}/{out}", f"{base}/ck-{out}",
                 edges, rated, trigger={"availableNow": True}, threshold=0.6,
                 include_incoming=include, **kw)
    q.awaitTermination()
    assert q.exception() is None
    return {r["mid"]: round(r["r"], 9) for r in RS.latest_recs(spark, f"{base}/{out}").first()["recs"]}


def test_bucket_pruning_keeps_trigger_items(spark):
    """Exclude mode: the trigger item is in no recent row, yet its
    neighbours must be found through bucket pruning."""
    base = shared_dir(spark, "test-stream-trig")
    pairs = [(1, 2, 0.9), (1, 3, 0.8), (2, 3, 0.7)]
    edges = spark.createDataFrame(pairs + [(b, a, s) for a, b, s in pairs],
                                  "mid long, other_mid long, sim double")
    ids = history.bucket_id_sets(spark.createDataFrame([(1,), (2,)], "mid long"), {"m": ("mid", 64)})["m"]
    assert len(ids) == 2     # items 1 and 2 fall in different buckets
    history.write_by_bucket(edges, f"{base}/e", "mid", 64)
    table = history.BucketedTable(spark, f"{base}/e", "mid")
    spark.createDataFrame(["7|2|4.0|10|1", "7|1|5.0|20|2"], "string").write.text(f"{base}/src")
    none = history.BucketedTable(spark, f"{base}/nothing-yet", "uid")
    # trigger 1; candidates 2 (0.9) and 3 (0.8)
    # without the incoming rating, recents = {2: 4.0}: only 3 scores, 0.7 * 4
    assert _recs(spark, base, "excl", table, none, False) == {3: 2.8}
    # with it, recents = {1: 5.0, 2: 4.0}: 2 -> 0.9*5; 3 -> (0.8*5 + 0.7*4)/2 + log2(2)
    assert _recs(spark, base, "incl", table, none, True) == {2: 4.5, 3: 4.4}


def test_messages_without_ids_and_rejects(spark):
    """Four-field messages: only the incoming one is left out."""
    base = shared_dir(spark, "test-stream-noid")
    pairs = [(1, 2, 0.9), (1, 3, 0.8), (2, 3, 0.7)]
    edges = spark.createDataFrame(pairs + [(b, a, s) for a, b, s in pairs],
                                  "mid long, other_mid long, sim double")
    lines = ["7|2|4.0|10", "7|1|5.0|20", "7|1|NaN|30", "7|1|Infinity|31", "nonsense"]
    spark.createDataFrame(lines, "string").write.text(f"{base}/src")
    none = spark.createDataFrame([], "uid long, mid long")
    assert _recs(spark, base, "excl", lambda: edges, lambda: none, False) == {3: 2.8}
    assert _recs(spark, base, "incl", lambda: edges, lambda: none, True) == {2: 4.5, 3: 4.4}
    q = RS.reject_sink(RS.flagged_messages(spark, "text", f"{base}/src"), f"{base}/bad", f"{base}/ck-bad",
                       {"availableNow": True})
    q.awaitTermination()
    assert [r[0] for r in rows(spark.read.parquet(f"{base}/bad"))] == sorted(lines[2:])


def test_a_wrong_table_is_an_error_and_not_an_empty_one(spark):
    import pytest
    from pyspark.errors import AnalysisException
    base = shared_dir(spark, "test-stream-wrong")
    spark.createDataFrame([(1, "x")], "user long, item string") \
        .withColumn("uid", F.col("user")).transform(lambda x: history.with_bucket(x, "uid", 4)) \
        .drop("uid").write.partitionBy("uid_buckets", "uid_bucket").parquet(f"{base}/t")
    keys = spark.createDataFrame([(1,)], "uid long")
    with pytest.raises(AnalysisException):
        history.lookup(keys, [(history.BucketedTable(spark, f"{base}/t", "uid"), ["uid"],
                               (("uid", "bigint"), ("mid", "bigint")))])[0].count()


def test_rated_items_in_state_over_restarts(spark):
    """A history given at every start counts once, in the first batch, and each message
    adds its item: the lists are those of a batch re-rank with history and messages
    as rated items. A user of the history alone gets no row."""
    d = SF_SMALL
    base = shared_dir(spark, "test-stream-rated")
    src, out = f"{base}/src", f"{base}/out"
    msgs = A.messages(spark, d)
    users = [r["uid"] for r in history.distinct_users(msgs).orderBy("uid").limit(40).collect()]
    msgs = msgs.where(F.col("uid").isin(users))
    edges = lambda: similarity.item_similarity(A.factors(spark, d), 0.3)
    first = history.distinct_pairs(A.ratings(spark, d))
    # Each user has rated three of the nearest items already.
    near = rerank.unseen_neighbours(rerank.latest_messages(msgs), edges(), first, 3, 0.3)
    first = first.unionByName(near.select("uid", "mid"))
    ignored = edges().select(F.explode(F.array(*[F.lit(u) for u in users])).alias("uid"), "mid").distinct()
    lines = A.message_lines(msgs, keep=["msg_id"])
    cut = msgs.approxQuantile("msg_id", [0.5], 0.0)[0]
    for part, hist in ((F.col("msg_id") <= cut, first), (F.col("msg_id") > cut, ignored)):
        lines.where(part).select("value").write.mode("append").text(src)
        q = RS.start(RS.message_stream(spark, "text", src), out, f"{base}/ckpt", edges,
                     RS.RatedInState(hist), trigger={"availableNow": True}, threshold=0.3,
                     state_partitions=4)
        q.awaitTermination()
        assert q.exception() is None
    got = RS.latest_recs(spark, out).select("uid", F.explode("recs").alias("x")) \
        .select("uid", F.col("x.mid").alias("mid"), F.round("x.r", 6).alias("score"))
    rated = first.unionByName(msgs.select("uid", "mid"))
    want = rerank.rerank(msgs, edges(), rated, threshold=0.3) \
        .select("uid", "mid", F.round("score", 6).alias("score"))
    assert rows(got) == rows(want) and got.count() > 0
    assert sorted(r["uid"] for r in RS.latest_recs(spark, out).select("uid").collect()) == users
    assert rows(RS.latest_recents(spark, out)) == rows(rerank.recents_from_messages(msgs, 20))
    # The same from the state store, and as it was after the first batch.
    ckpt = f"{base}/ckpt"
    assert rows(RS.state_recents(spark, ckpt)) == rows(rerank.recents_from_messages(msgs, 20))
    assert rows(RS.state_recents(spark, ckpt, 3)) == rows(rerank.recents_from_messages(msgs, 3))
    assert rows(RS.state_rated(spark, ckpt)) == rows(rated.distinct())
    older = msgs.where(F.col("msg_id") <= cut)
    assert rows(RS.state_recents(spark, ckpt, batch_id=0)) == rows(rerank.recents_from_messages(older, 20))
    assert rows(RS.state_rated(spark, ckpt, batch_id=0)) == \
        rows(first.unionByName(older.select("uid", "mid")).distinct())


def test_batches_collect_no_join_side_on_the_driver(spark, monkeypatch):
    """Written tables look small by their compressed files; neither the re-rank of a
    batch nor the joins that fill the state may broadcast them for that."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    base = shared_dir(spark, "no-broadcast")
    msgs = spark.createDataFrame([(u, 7 + u, 4.0, 100 + u, u) for u in range(6)],
                                 "uid long, mid long, score double, timestamp long, msg_id long")
    A.message_lines(msgs).write.text(f"{base}/src")
    pairs = [(a, b, 0.5 + 0.01 * a) for a in range(7, 13) for b in range(7, 13) if a != b]
    history.write_by_bucket(spark.createDataFrame(pairs, "mid long, other_mid long, sim double"),
                            f"{base}/edges", "mid")
    # The history is a join of two small tables, as that of the adapters.
    spark.createDataFrame([(u, u) for u in range(6)], "o long, uid long").write.parquet(f"{base}/orders")
    spark.createDataFrame([(u, 8 + u) for u in range(6)], "o long, mid long").write.parquet(f"{base}/lines")
    rated = spark.read.parquet(f"{base}/lines").join(spark.read.parquet(f"{base}/orders"), "o").select("uid", "mid")
    history.write_by_bucket(rated, f"{base}/rated", "uid")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    plans, nested = [], rerank.nested_recs
    monkeypatch.setattr(rerank, "nested_recs", lambda scores: plans.append(plan(scores)) or nested(scores))
    for name, given in (("table", history.BucketedTable(spark, f"{base}/rated", "uid")),
                        ("state", RS.RatedInState(rated))):
        q = RS.start(RS.message_stream(spark, "text", f"{base}/src"), f"{base}/{name}", f"{base}/{name}-ckpt",
                     history.BucketedTable(spark, f"{base}/edges", "mid"), given,
                     trigger={"availableNow": True}, threshold=0.3)
        assert spark.conf.get(key) == before
        q.awaitTermination()
        assert q.exception() is None
        plans.append(q._jsq.explainInternal(False))
        assert RS.latest_recs(spark, f"{base}/{name}").where("size(recs) > 0").count() == 6
    assert len(plans) == 4 and all("TransformWithState" in x for x in plans[1::2])
    assert plans[0].count("SortMergeJoin") >= 4 and plans[3].count("SortMergeJoin") >= 1
    assert not any("Broadcast" in x for x in plans)


def test_lookups_send_only_rows_of_the_batchs_keys(spark):
    """A bucket holds many keys; those that the batch does not have are left out where
    the table is read, int and bigint keys alike."""
    base = shared_dir(spark, "sketch")
    edges = spark.range(4000).selectExpr("id % 1000 AS mid", "id AS other_mid", "0.5D AS sim")
    history.write_by_bucket(edges, f"{base}/edges", "mid", 2)
    rated = spark.createDataFrame([(u, u + 1) for u in range(2000)], "uid int, mid int")
    history.write_by_bucket(rated, f"{base}/rated", "uid", 2)
    batch = spark.createDataFrame([(5, 7, 9), (1999, None, 7), (None, 11, None)], "uid long, mid long, trig_mid long")
    found, seen = history.lookup(batch, [
        (history.BucketedTable(spark, f"{base}/edges", "mid"), ["mid", "trig_mid"], RS.EDGES),
        (history.BucketedTable(spark, f"{base}/rated", "uid"), ["uid"], RS.RATED)])
    got = {r["mid"] for r in found.collect()}
    assert {7, 9, 11} <= got and len(got) < 10 and found.where("mid = 7").count() == 4
    got = {r["uid"] for r in seen.collect()}
    assert {5, 1999} <= got and len(got) < 10
    words = history.key_sketch(batch, ["mid"], 64)   # 64 bits: others pass, but never fewer
    few = history.sketched(rated, "uid", words)
    assert len(words) == 1 and {7, 11} <= {r["uid"] for r in few.collect()} and few.count() < 2000


def test_edges_are_stored_once(spark, monkeypatch):
    """The similarity table goes straight to its buckets, with no copy beside it."""
    from conftest import SF_SMALL

    from ratings_spark.plans import stream_queries
    from ratings_spark.session import list_folder
    made, wanted = [], stream_queries.shared_dir
    monkeypatch.setattr(stream_queries, "shared_dir", lambda *a: made.append(wanted(*a)) or made[-1])
    # The scratch folders of this run alone.
    top = shared_dir(spark, "x").rsplit("/", 1)[0]
    before = set(list_folder(spark, top))
    stream_queries.run_stream(spark, SF_SMALL, slices=2)
    new = set(list_folder(spark, top)) - before
    assert f"{made[0]}".rsplit("/", 1)[1] in new and not any(x.startswith("edges-") for x in new)
    assert spark.read.parquet(f"{made[0]}/item_recs").count() > 0
