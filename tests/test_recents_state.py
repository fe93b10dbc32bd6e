"""The stream's per-user reduction and batch sink, tested directly."""

import pandas as pd
from conftest import rows
from pyspark.sql import Row

from ratings_spark.streaming import recents
from ratings_spark.streaming import rerank_stream as RS
from ratings_spark.session import shared_dir


def test_newest_dedupes_and_orders():
    items = [(1, 1.0, 10, 1), (2, 2.0, 30, 7), (3, 3.0, 30, 9), (4, 4.0, 20, 4), (5, 5.0, 30, 7)]
    assert [x[0] for x in recents.newest(items, 3)] == [3, 2, 4]   # (30, 9), (30, 7) once, then (20, 4)
    noid = [(1, 1.0, 10, None), (2, 2.0, 10, None), (3, 3.0, 10, 0)]
    assert [x[0] for x in recents.newest(noid, 3)] == [3, 1, 2]
    assert recents.newest(noid[::-1], 3) == recents.newest(noid, 3)


def test_batch_reduction_keeps_hot_user_exact():
    fn = recents.newest_per_batch(3)
    hot = pd.DataFrame({"uid": [0] * 1000 + [1, 1], "mid": list(range(1000)) + [7, 8],
                        "score": [1.0] * 1002, "timestamp": list(range(1000)) + [5, 6],
                        "msg_id": list(range(1002))})
    chunks = [hot.iloc[i:i + 97] for i in range(0, len(hot), 97)]   # many Arrow batches
    out = pd.concat(list(fn(iter(chunks))))
    assert len(out) <= 3 * len(chunks) + 2
    assert sorted(out[out.uid == 0]["mid"].tolist())[-3:] == [997, 998, 999]
    assert sorted(out[out.uid == 1]["mid"].tolist()) == [7, 8]
    # a message repeated many times does not push others out of its batch
    again = pd.DataFrame({"uid": [0] * 6, "mid": [1, 1, 1, 1, 2, 3], "score": [1.0] * 6,
                          "timestamp": [9, 9, 9, 9, 8, 7], "msg_id": [5, 5, 5, 5, 4, 3]})
    assert next(fn(iter([again])))["mid"].tolist() == [1, 2, 3]


def test_batch_reduction_keeps_every_item_when_asked():
    fn = recents.newest_per_batch(2, every_item=True)
    b = pd.DataFrame({"uid": [0] * 6, "mid": [1, 1, 1, 2, 3, 3], "score": [1.0] * 6,
                      "timestamp": [9, 8, 7, 6, 5, 4], "msg_id": [6, 5, 4, 3, 2, 1]})
    out = next(fn(iter([b])))
    assert list(zip(out["mid"], out["timestamp"])) == [(1, 9), (1, 8), (2, 6), (3, 5)]


class Store:
    """A state variable as the processor uses it."""

    def __init__(self):
        self.d, self.written = {}, 0

    def get(self):
        return self.d.get("list", [])

    def put(self, items):
        self.d["list"] = items

    def containsKey(self, k):
        return k in self.d

    def getValue(self, k):
        return self.d[k]

    def updateValue(self, k, v):
        self.d[k], self.written = v, self.written + 1

    def values(self):
        return iter(list(self.d.values()))


class Handle:
    def getListState(self, *_):
        return Store()

    def getMapState(self, *_):
        return Store()


def test_rated_chunks_are_bounded_and_written_only_when_changed(monkeypatch):
    monkeypatch.setattr(recents, "HELD_IDS", 7)
    p = recents.RecentAndRated(3)
    p.init(Handle())
    p.handleInitialState((5,), Row(uid=5, chunk=0, mids=[1, 2]), None)
    p.handleInitialState((5,), Row(uid=5, chunk=-1, mids=[-4096, -1]), None)
    msg = [Row(uid=5, mid=m, score=1.0, timestamp=k, msg_id=k) for k, m in enumerate([2, -1, *range(0, 9000, 3)])]
    out = list(p.handleInputRows((5,), iter(msg), None))
    recent = [r["mid"] for r in out if r["rank"]]
    chunks = [r["rated"] for r in out if r["rated"] is not None]
    assert recent == [8997, 8994, 8991] and all(r["rated"] is None for r in out if r["rank"])
    assert sorted(m for c in chunks for m in c) == sorted({1, 2, -4096, -1, *range(0, 9000, 3)})
    assert all(len(c) <= 2 ** recents.CHUNK_BITS and len({m >> recents.CHUNK_BITS for m in c}) == 1 for c in chunks)
    before = p.rated.written
    again = list(p.handleInputRows((5,), iter(msg[:50]), None))
    assert p.rated.written == before and [r for r in again if r["rated"]] == [r for r in out if r["rated"]]
    assert list(p.handleInputRows((5,), iter([]), None)) == []


def test_history_chunks(spark):
    h = spark.createDataFrame([(1, 5), (1, 5), (1, 4096), (1, -1), (2, 5), (None, 5), (2, None)],
                              "uid int, mid int")
    got = [(r["uid"], r["chunk"], sorted(r["mids"])) for r in RS.RatedInState(h).chunks().collect()]
    assert sorted(got) == [(1, -1, [-1]), (1, 0, [5]), (1, 1, [4096]), (2, 0, [5])]
    assert RS.RatedInState().chunks() is None and RS.RatedInState(h.limit(0)).chunks().count() == 0


def test_replayed_batch_overwrites_itself(spark):
    base = shared_dir(spark, "test-replay")
    batch = spark.createDataFrame(
        [(1, 5, 0, 1, 1, 5, 4.0, 1, True), (1, 5, 0, 1, 2, 6, 3.0, 0, False)],
        "uid long, trig_mid long, trig_timestamp long, trig_msg_id long, rank int, mid long, "
        "score double, msg_id long, is_trigger boolean")
    edges = spark.createDataFrame([(5, 9, 0.9), (9, 5, 0.9), (6, 9, 0.8), (9, 6, 0.8)],
                                  "mid long, other_mid long, sim double")
    rated = spark.createDataFrame([], "uid long, mid long")
    w = RS.batch_writer(base, lambda: edges, lambda: rated, threshold=0.6)
    w(batch, 3)
    w(batch, 3)   # replay after a failure
    recs = spark.read.parquet(f"{base}/recs")
    assert recs.count() == 1 and recs.first()["batch_id"] == 3
    got = {r["mid"]: round(r["r"], 9) for r in recs.first()["recs"]}
    assert got == {9: round((0.9 * 4 + 0.8 * 3) / 2, 9)}   # one positive, one negative
    assert rows(spark.read.parquet(f"{base}/recents").select("uid", "rank")) == [(1, 1), (1, 2)]


def test_first_ids_of_a_user_share_one_entry(monkeypatch):
    monkeypatch.setattr(recents, "LIST_IDS", 5)
    p = recents.RecentAndRated(3)
    p.init(Handle())
    p.handleInitialState((5,), Row(uid=5, chunk=recents.LIST_KEY, mids=[90_000, 7]), None)
    say = lambda *mids: [r["rated"] for r in p.handleInputRows(
        (5,), iter([Row(uid=5, mid=m, score=1.0, timestamp=k, msg_id=k) for k, m in enumerate(mids)]), None)
        if r["rated"] is not None]
    assert say(7, 90_000) == [[7, 90_000]] and p.rated.written == 1   # the fill alone
    assert say(1, 50_000) == [[1, 7, 50_000, 90_000]]
    assert sorted(say(2, 1, 50_001, 8)) == [[1, 2, 7, 50_000, 90_000], [8], [50_001]]
    assert sorted(say(8, 9)) == [[1, 2, 7, 50_000, 90_000], [8, 9], [50_001]]
    # A user without any, and one whose state has chunks alone.
    other = recents.RecentAndRated(3)
    other.init(Handle())
    p = other
    assert say(4, 70_000) == [[4, 70_000]]
    p = recents.RecentAndRated(3)
    p.init(Handle())
    p.handleInitialState((5,), Row(uid=5, chunk=0, mids=[1]), None)
    assert sorted(say(70_000, 2)) == [[1, 2], [70_000]]


def test_history_entries(spark, monkeypatch):
    h = spark.createDataFrame([(1, 5), (1, 5), (1, 4096), (1, -1), (1, 99_999), (2, 5), (None, 5), (2, None)],
                              "uid int, mid int")
    got = lambda: sorted((r["uid"], r["chunk"], sorted(r["mids"])) for r in RS.RatedInState(h).entries().collect())
    assert got() == [(1, recents.LIST_KEY, [-1, 5, 4096, 99_999]), (2, recents.LIST_KEY, [5])]
    monkeypatch.setattr(RS, "LIST_IDS", 2)
    assert got() == [(1, recents.LIST_KEY, [-1, 5]), (1, 1, [4096]), (1, 24, [99_999]), (2, recents.LIST_KEY, [5])]
    assert RS.RatedInState().entries() is None
    plan = RS.RatedInState(h).entries()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
