"""Cosine similarity: thresholds, zero vectors, blocking/chunking exactness."""

import numpy as np
from conftest import SF_SMALL, rows

from ratings_spark.operators import similarity
from ratings_spark.sources import adapters as A


def factors_df(spark, data):
    return spark.createDataFrame(data, "id long, features array<float>")


def brute_force(vecs: dict, t: float):
    ids = sorted(vecs)
    out = set()
    for a in ids:
        for b in ids:
            if a == b:
                continue
            x, y = np.asarray(vecs[a], float), np.asarray(vecs[b], float)
            n = np.linalg.norm(x) * np.linalg.norm(y)
            if n > 0 and x @ y / n > t:
                out.add((a, b))
    return out


def test_zero_identical_and_strict_threshold(spark):
    f = factors_df(spark, [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]),
                           (4, [3.0, 4.0]), (5, [0.0, 1.0])])
    e = similarity.item_similarity(f, 0.6)
    got = {(r["mid"], r["other_mid"]): r["sim"] for r in e.collect()}
    # identical directions -> 1.0; zero vector never appears; cos(1,4)=0.6 is not > 0.6
    assert set(got) == {(1, 2), (2, 1), (4, 5), (5, 4)}
    assert abs(got[(1, 2)] - 1.0) < 1e-12 and abs(got[(4, 5)] - 0.8) < 1e-6


def test_blocked_matches_brute_force_any_block_size(spark):
    f = A.factors(spark, SF_SMALL)
    vecs = {r["id"]: r["features"] for r in f.collect()}
    want = brute_force(vecs, 0.3)
    for br in (None, 7, 64):
        e = similarity.item_similarity(f, 0.3, block_rows=br)
        got = set(rows(e, "mid", "other_mid"))
        assert got == want
    sims = {(r["mid"], r["other_mid"]): r["sim"] for r in e.collect()}
    assert all(abs(sims[(a, b)] - sims[(b, a)]) < 1e-12 for a, b in sims)   # symmetric
    assert all(a != b for a, b in sims) and all(s > 0.3 for s in sims.values())


def test_chunked_products_match(spark, monkeypatch):
    from ratings_spark.operators import factors, similarity as sim
    f = A.factors(spark, SF_SMALL)
    want = set(rows(sim.item_similarity(f, 0.3), "mid", "other_mid"))
    want_top = rows(factors.top_k_items(f, f, 3), "uid", "rank", "mid")
    monkeypatch.setattr(sim, "CHUNK_ROWS", 5)
    monkeypatch.setattr(factors, "CHUNK_ROWS", 5)
    assert set(rows(sim.item_similarity(f, 0.3, block_rows=40), "mid", "other_mid")) == want
    assert rows(factors.top_k_items(f, f, 3, block_rows=40), "uid", "rank", "mid") == want_top


def test_clustered_vectors_skip_block_pairs(spark):
    """Twenty tight clusters in far directions: the pivot form finds the same
    edges and multiplies far fewer block pairs."""
    rng = np.random.default_rng(4)
    centres = np.linalg.qr(rng.normal(size=(24, 24)))[0][:20]
    vecs = [(k, (centres[k % 20] + 0.01 * rng.normal(size=24)).tolist()) for k in range(600)]
    f = spark.createDataFrame(vecs, "id long, features array<double>")
    want = rows(similarity.item_similarity(f, 0.9), "mid", "other_mid")
    assert len(want) == 600 * 29
    got = similarity.item_similarity(f, 0.9, pivots=100, block_rows=50)
    assert rows(got, "mid", "other_mid") == want
    uv = f.selectExpr("id", "features AS v")
    blocked, groups, copies = similarity._pivot_blocks(uv, 0.9, 50, 100)
    pairs = blocked.select("p", "q").distinct().count()
    blocks = blocked.select("b").distinct().count()
    assert pairs <= groups and blocked.count() == copies
    assert pairs < 0.2 * blocks * (blocks + 1) / 2


def test_pivots_change_nothing_elsewhere(spark):
    f = A.factors(spark, SF_SMALL)
    want = rows(similarity.item_similarity(f, 0.3), "mid", "other_mid")
    for pivots, rows_ in ((1, 64), (7, 16), (50, None)):
        assert rows(similarity.item_similarity(f, 0.3, rows_, pivots=pivots), "mid", "other_mid") == want
    assert similarity.item_similarity(f.limit(0), 0.3, pivots=5).count() == 0


def test_results_do_not_depend_on_partitions_or_repeated_ids(spark, monkeypatch):
    from ratings_spark.operators import blocks, factors
    f = A.factors(spark, SF_SMALL)
    twice = f.unionByName(f.selectExpr("id", "transform(features, x -> x - 10) AS features"))
    want = rows(similarity.item_similarity(f, 0.3))
    top = rows(factors.top_k_items(f, f, 3))
    for n in (10, 10_000):
        monkeypatch.setattr(blocks, "PARTITION_ROWS", n)
        got = rows(similarity.item_similarity(twice.repartition(7), 0.3, block_rows=50))
        assert [r[:2] for r in got] == [r[:2] for r in want]
        assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(got, want))
        assert [r[:3] for r in rows(factors.top_k_items(f, f, 3, block_rows=50))] == [r[:3] for r in top]


def test_neighbour_lists(spark):
    f = A.factors(spark, SF_SMALL)
    e = similarity.item_similarity(f, 0.3)
    top = similarity.neighbour_lists(e, 3)
    per = {}
    for r in top.collect():
        per.setdefault(r["mid"], []).append((r["rank"], r["sim"]))
    for lst in per.values():
        lst.sort()
        assert len(lst) <= 3 and [s for _, s in lst] == sorted((s for _, s in lst), reverse=True)
    assert similarity.neighbour_lists(e).count() == e.count()


def unit(X):
    return X / np.linalg.norm(X, axis=1)[:, None]


def test_most_products_end_after_the_first_axes():
    """Vectors without clusters, of even and of falling spectrum, in turned
    coordinates: few axes leave few products open, and the pairs are those of the
    whole products."""
    rng = np.random.default_rng(7)
    for d, fall, most_axes in ((128, 0.0, 96), (128, 0.5, 96), (64, 0.0, 48)):
        turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
        X = unit(rng.normal(size=(900, d)) * np.arange(1, d + 1) ** -fall @ turn)
        Y = unit(rng.normal(size=(700, d)) * np.arange(1, d + 1) ** -fall @ turn)
        axes = similarity.principal_axes(X, Y)
        m = similarity.first_axes(X, Y, axes, 0.6)
        assert 0 < m <= most_axes
        bound = similarity.bounded_rows(X, axes, m) @ similarity.bounded_rows(Y, axes, m).T
        full = bound > 0.6 - similarity.slack(d)
        assert full.mean() < 0.02                       # share multiplied in full
        assert not ((X @ Y.T > 0.6) & ~full).any()
        assert (bound + similarity.slack(d) >= X @ Y.T).all()


def test_pairs_are_the_same_whatever_axes_are_tried(monkeypatch):
    rng = np.random.default_rng(8)
    for d in (1, 2, 3, 8, 33):
        X = unit(rng.normal(size=(120, d)))
        X[7], X[8] = X[3], -X[3]
        for t in (-0.2, 0.5, 0.97):
            S = X @ X.T
            want = {(i, j) for i in range(120) for j in range(i + 1, 120) if S[i, j] > t + 1e-12}
            edge = {(i, j) for i in range(120) for j in range(i + 1, 120) if abs(S[i, j] - t) <= 1e-12}
            for m in (0, 1, d // 2, d):
                monkeypatch.setattr(similarity, "first_axes", lambda *a, m=m: m)
                monkeypatch.setattr(similarity, "CHUNK_ROWS", 17)
                monkeypatch.setattr(similarity, "OPEN_PAIRS", 11)
                parts = list(similarity._above(X, X, t, True))
                got = [(int(a), int(b)) for i, j, _ in parts for a, b in zip(i, j)]
                assert len(got) == len(set(got)) and set(got) | edge == want | edge
                assert all(abs(S[i, j] - s) < 1e-12 for i, j, s in parts for i, j, s in zip(i, j, s))
            monkeypatch.undo()
