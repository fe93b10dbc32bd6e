import math
import zlib

import helpers as H
import numpy as np

from ratings_spark.llm import classifier as C

DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    rows = C.quality(spark.read.parquet(f"{DIR}/documents.parquet"), labels).join(labels, "doc_id")
    rows = rows.where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good >= 0.5).mean() > 0.99 and (bad < 0.5).mean() > 0.97
    assert (good[:, None] > bad[None, :]).mean() > 0.995


def test_held_out_labels_and_bad_labels_are_not_learnt(spark):
    docs, labels = (spark.read.parquet(f"{H.SF}/{t}.parquet") for t in ("documents", "labels"))
    fold = C.in_training_fold(labels["doc_id"])
    from pyspark.sql import functions as F
    other = labels.withColumn("quality", F.when(fold, F.col("quality")).otherwise(1 - F.col("quality")))
    other = other.withColumn("quality", F.when(fold & (F.col("quality") == 0), None).otherwise(F.col("quality")))
    assert other.where("quality is null").count() > 0
    # rows whose label went are unlabelled now, so only those of the other fold may change nothing
    same = labels.withColumn("quality", F.when(fold, F.col("quality")).otherwise(1 - F.col("quality")))
    assert H.rows_of(C.quality(docs, labels)) == H.rows_of(C.quality(docs, same))


def test_odd_rows_and_clashing_columns(spark):
    docs = H.odd(spark, "x", "score", "doc", "label", "quality")
    labels = spark.createDataFrame([(6, 1, 0), (6, 0, 0), (9, 1, None), (None, 1, 1), (7, None, 1)],
                                   "doc_id bigint, quality int, toxic int")
    scored = C.quality(docs, labels)
    assert scored.count() == docs.count()
    assert scored.where("score is null or score < 0 or score > 1 or predicted is null").count() == 0
    assert C.keep_good(docs, labels).columns == docs.columns


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = H.odd(spark)
    assert {r["score"] for r in C.quality(docs, none).collect()} == {0.5}
    assert C.keep_good(docs, none).count() == docs.count()
    assert C.quality(H.nothing(spark), none).collect() == []


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(5)
    good, bad = rng.normal(2, 1, (6000, len(C.FEATURES))), rng.normal(-2, 1, (6000, len(C.FEATURES)))
    model = C.fit(good[:3000], np.vstack([good[3000:], bad[:1000]]))
    assert abs(model.prior - 0.75) < 0.03
    assert (model.score(bad[1000:]) < 0.5).mean() > 0.98 and (model.score(good) > 0.5).mean() > 0.98


def test_keep_good_agrees_with_the_scores(spark):
    docs, labels = (spark.read.parquet(f"{H.SF}/{t}.parquet") for t in ("documents", "labels"))
    want = H.rows_of(C.quality(docs, labels).where("predicted = 1"), "doc_id")
    assert H.rows_of(C.keep_good(docs, labels), "doc_id") == want


def test_risk_and_its_slope_against_brute_force():
    rng = np.random.default_rng(7)
    p, u = rng.normal(1, 1, (40, 5)), rng.normal(0, 1, (60, 5))

    def loss(z):
        return math.log1p(math.exp(-z))

    clipped = 0
    for size in (0.1, 1, 6):
        for prior in (0.2, 0.6, 0.95):
            w = size * rng.normal(1, 1, 5)
            plus = prior * sum(loss(float(r @ w)) for r in p) / len(p)
            minus = (sum(loss(-float(r @ w)) for r in u) / len(u)
                     - prior * sum(loss(-float(r @ w)) for r in p) / len(p))
            np.testing.assert_allclose(C.risk_parts(w, p, u, prior), (plus, minus), rtol=1e-9)
            clipped += minus < 0

            def followed(v):
                a, b = C.risk_parts(v, p, u, prior)
                return -b if minus < 0 else a + b

            step = 1e-6 * np.eye(5)
            slope = [(followed(w + e) - followed(w - e)) / 2e-6 for e in step]
            np.testing.assert_allclose(C.risk_slope(w, p, u, prior), slope, atol=1e-6)
    assert 0 < clipped < 9


def test_statistics_cover_all_unlabelled_rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(0, 1, (5000, len(C.FEATURES))).astype(np.float32)
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "x array<float>").repartition(7)
    whole, here = C.Corpus(rows), C.Sample(x)
    for a, b in zip(whole.moments(), here.moments()):
        np.testing.assert_allclose(a, b, rtol=1e-5, atol=1e-6)
    width = 2 * len(C.FEATURES) + 1
    models = [C.Model(np.zeros(len(C.FEATURES)), np.ones(len(C.FEATURES)), rng.normal(0, 1, width), 0.5)
              for _ in range(2)]
    t = np.array([np.linspace(-5, 5, 20), np.linspace(-2, 2, 20)])
    n, above = whole.above(models, t)
    half = C.half_of(x)
    assert n == 5000 and set(half.tolist()) == {0, 1}
    assert above.tolist() == [sum(models[h].margin(r[None])[0] >= t[h, i] for r, h in zip(x, half))
                              for i in range(20)]


def test_prior_rows_beyond_the_drawn_ones_count():
    """Drawn rows are half good, the corpus 0.8: the prior is the corpus's."""
    rng = np.random.default_rng(3)
    good, bad = rng.normal(2, 1, (9000, len(C.FEATURES))), rng.normal(-2, 1, (3000, len(C.FEATURES)))
    corpus = C.Sample(np.vstack([good[1000:], bad[:2000]]))
    model = C.fit(good[:1000], np.vstack([good[1000:2000], bad[:1000]]), corpus)
    assert abs(model.prior - 0.8) < 0.05
