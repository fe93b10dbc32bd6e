"""Re-rank score formula branches, anti join, limits, latest message and versions."""

import math

from conftest import rows

from ratings_spark.session import shared_dir
from ratings_spark.operators import rerank


def edges(spark, pairs):
    data = []
    for a, b, s in pairs:
        data += [(a, b, s), (b, a, s)]
    return spark.createDataFrame(data, "mid long, other_mid long, sim double")


def msgs(spark, data):
    return spark.createDataFrame(data, "uid long, mid long, score double, timestamp long, msg_id long")


def test_score_formula_branches(spark):
    # user 1 rates item 1 (trigger). Candidates 2 and 3 are neighbours of 1.
    e = edges(spark, [(1, 2, 0.9), (1, 3, 0.8), (2, 4, 0.7), (3, 5, 0.65), (2, 5, 0.1)])
    m = msgs(spark, [
        (1, 4, 3.0, 10, 1),   # exactly 3 -> negative
        (1, 5, 2.0, 11, 2),
        (1, 1, 5.0, 12, 3),   # trigger, positive
    ])
    rated = spark.createDataFrame([], "uid long, mid long")
    got = {r["mid"]: r["score"] for r in rerank.rerank(m, e, rated, threshold=0.6).collect()}
    # cand 2: P = {1 (0.9*5), 4 (0.7*3)} -> 1 pos, 1 neg
    assert math.isclose(got[2], (0.9 * 5 + 0.7 * 3) / 2 + math.log2(1) - math.log2(1))
    # cand 3: P = {1 (0.8*5), 5 (0.65*2)} -> 1 pos, 1 neg
    assert math.isclose(got[3], (0.8 * 5 + 0.65 * 2) / 2)
    assert set(got) == {2, 3}


def test_zero_positive_and_zero_negative(spark):
    e = edges(spark, [(1, 2, 0.9), (2, 3, 0.8), (2, 4, 0.7)])
    only_neg = msgs(spark, [(1, 3, 1.0, 1, 1), (1, 4, 2.0, 2, 2), (1, 1, 1.0, 3, 3)])
    rated = spark.createDataFrame([], "uid long, mid long")
    got = {r["mid"]: r["score"] for r in rerank.rerank(only_neg, e, rated, threshold=0.6).collect()}
    assert math.isclose(got[2], (0.8 + 1.4 + 0.9) / 3 - math.log2(3))
    only_pos = msgs(spark, [(1, 3, 4.0, 1, 1), (1, 4, 5.0, 2, 2), (1, 1, 3.5, 3, 3)])
    got = {r["mid"]: r["score"] for r in rerank.rerank(only_pos, e, rated, threshold=0.6).collect()}
    assert math.isclose(got[2], (3.2 + 3.5 + 0.9 * 3.5) / 3 + math.log2(3))


def test_rated_items_removed_and_limit(spark):
    e = edges(spark, [(1, i, 0.99 - i / 100) for i in range(2, 30)])
    m = msgs(spark, [(7, 1, 4.0, 1, 1)])
    rated = spark.createDataFrame([(7, 2), (7, 3), (8, 4)], "uid long, mid long")
    c = rerank.unseen_neighbours(rerank.latest_messages(m), e, rated, 20, 0.6)
    mids = [r["mid"] for r in c.orderBy("rank").collect()]
    assert mids == list(range(4, 24))    # 2, 3 rated by user 7; best 20 of the rest


def test_item_without_neighbours_and_latest_message(spark):
    e = edges(spark, [(1, 2, 0.9)])
    m = msgs(spark, [(1, 1, 5.0, 1, 1), (1, 99, 5.0, 2, 2)])   # latest is 99: no neighbours
    rated = spark.createDataFrame([], "uid long, mid long")
    assert rerank.rerank(m, e, rated, threshold=0.6).count() == 0
    same_second = msgs(spark, [(1, 99, 5.0, 2, 5), (1, 1, 5.0, 2, 6)])  # id breaks the tie
    assert rows(rerank.latest_messages(same_second), "uid", "mid") == [(1, 1)]


def test_recents_exactly_n_and_repeats(spark):
    m = msgs(spark, [(1, i % 3, 1.0, i, i) for i in range(21)])
    r = rerank.recents_from_messages(m, 20)
    assert r.count() == 20 and r.where("mid = 0").count() == 6   # same item repeats kept


def test_latest_version(spark):
    v = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, "d")],
                              "uid long, batch_id int, x string")
    assert rows(rerank.latest_version(v), "uid", "x") == [(1, "b"), (1, "c"), (2, "d")]


def test_hot_item_is_not_expanded_beyond_what_can_matter(spark):
    """2000 neighbours of one item, 50 users: a user with r rated items joins
    20 + r of them, and the best 20 unseen ones are the same as without bound."""
    sims = [(0, k, 1.0 - k / 10_000) for k in range(1, 2001)]
    e = spark.createDataFrame(sims, "mid long, other_mid long, sim double")
    trig = spark.createDataFrame([(u, 0) for u in range(50)], "uid long, mid long")
    seen = [(u, k) for u in range(50) for k in range(1, u + 1)] + [(7, 1900), (7, 1)]
    rated = spark.createDataFrame(seen, "uid long, mid long")
    pairs = rated.distinct()
    joined = rerank.candidate_pairs(trig, e, pairs, 20, 0.6).groupBy("uid").count()
    assert {r["uid"]: r["count"] for r in joined.collect()} == {u: 20 + u + (u == 7) for u in range(50)}
    want = [(u, k - u, k) for u in range(50) for k in range(u + 1, u + 21)]
    for salts in (1, 8):
        got = rerank.unseen_neighbours(trig, e, rated, 20, 0.6, salts)
        assert rows(got, "uid", "rank", "mid") == sorted(want)


def test_salted_scores_are_the_same(spark):
    e = edges(spark, [(a, b, 0.6 + 0.01 * (a + b)) for a in range(8) for b in range(a + 1, 8)])
    cands = spark.createDataFrame([(u, 1, m, 0.9) for u in range(9) for m in range(4)],
                                  "uid long, rank int, mid long, sim double")
    rec = spark.createDataFrame([(u, 1, m, float(m)) for u in range(9) for m in range(4, 8)],
                                "uid long, rank int, mid long, score double")
    one = rows(rerank.rerank_scores(cands, rec, e, 0.6), "uid", "mid", "score")
    many = rows(rerank.rerank_scores(cands, rec, e, 0.6, salts=4), "uid", "mid", "score")
    assert [x[:2] for x in one] == [x[:2] for x in many] and len(one) == 36
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(one, many))


def test_edges_are_written_for_items_with_messages_only(spark, monkeypatch):
    """Of all edges those of message items, and with them the scores of the whole table."""
    from ratings_spark.operators import similarity
    from ratings_spark.plans import realtime_queries as Q
    f = spark.createDataFrame([(k, [1.0, 0.1 * k, 0.02 * (k % 7)]) for k in range(1, 31)], "id bigint, features array<float>")
    msgs = spark.createDataFrame([(u, m, s, t, 10 * u + t) for u, m, s, t in [
        (1, 3, 4.0, 1), (1, 5, 2.0, 2), (2, 3, 5.0, 1), (2, 40, 1.0, 2), (3, None, 3.0, 1), (4, 12, 3.5, 3)]],
        "uid bigint, mid bigint, score double, timestamp bigint, msg_id bigint")
    rated = spark.createDataFrame([(1, 6), (1, 6), (4, 11), (9, 1)], "uid bigint, mid bigint")
    for name, table in (("factors", f), ("messages", msgs), ("ratings", rated)):
        monkeypatch.setattr(Q.A, name, lambda spark, d, table=table: table)
    written, write = [], Q.materialize
    monkeypatch.setattr(Q, "materialize", lambda df, name: written.append(write(df, name)) or written[-1])
    got = {r["uid"]: 0 for r in Q.q_rerank_scores(spark, "").collect()}
    assert {r["mid"] for r in written[0].select("mid").distinct().collect()} == {3, 5, 12}
    whole = similarity.item_similarity(f, Q.RERANK_SIM)
    want = rerank.rerank(msgs, whole, rated, 20, 20, Q.RERANK_SIM)
    assert set(got) == {r["uid"] for r in want.select("uid").collect()} and got
    for query in (Q.q_rerank_scores, Q.q_latest_recs):
        rows = {(r["uid"], r["mid"]): r["score"] for r in query(spark, "").collect()}
        assert rows == {(r["uid"], r["mid"]): round(r["score"], 6) for r in want.collect()}


def test_rated_pairs_are_shuffled_once(spark):
    """The count of a user's rated items and the anti join share one shuffle of the pairs,
    without adaptive execution too, as in a stream's batches; nulls match nothing."""
    pairs = spark.createDataFrame([(1, 5), (1, 5), (1, None), (None, 6), (2, 6)], "uid long, mid long")
    pairs.write.parquet(path := shared_dir(spark, "rated-once"))
    trig = spark.createDataFrame([(1, 4), (2, 4)], "uid long, mid long")
    edges = spark.createDataFrame([(4, 5, 0.9), (4, 6, 0.8)], "mid long, other_mid long, sim double")
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = rerank.unseen_neighbours(trig, edges, spark.read.parquet(path), 20, 0.3)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in plan and plan.count("FileScan parquet") == 1
        assert rows(got, "uid", "mid") == [(1, 6), (2, 5)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
