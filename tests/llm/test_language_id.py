"""Language identification: kernels and regression against plain forms, held-out accuracy."""

import zlib

import helpers as H
import numpy as np
from pyspark.sql import functions as F

from ratings_spark.llm import language_id as L


def plain_grams(text):
    bare = " " + " ".join("".join(c if c.isalpha() or c.isalnum() and not c.isdecimal() else " "
                                  for c in text.lower()).split()) + " "
    return {bare[i:i + n] for n in (1, 2, 3) for i in range(len(bare) - n + 1)}


def plain_kernel(a, b):
    x, y = plain_grams(a), plain_grams(b)
    return len(x & y) / (len(x) * len(y)) ** 0.5


TEXTS = ["Hello, world! 12 times", "héllo Wörld", "中文 字符 \U0001f600 abc", "a", "x_y-z", "the cat sat on the mat " * 30,
         "ÀÉÎ", "one\ntwo\tthree", "zzz"]


def test_kernels_by_definition():
    base = L.Landmarks.of([L.spectrum(t) for t in TEXTS[:5]])
    got = base.kernels(TEXTS)
    for i, a in enumerate(TEXTS):
        for j, b in enumerate(TEXTS[:5]):
            assert abs(got[i, j] - plain_kernel(a, b)) < 1e-6
            assert abs(L.kernel(L.spectrum(a), L.spectrum(b)) - plain_kernel(a, b)) < 1e-12


def test_blocks_and_pieces_change_nothing(monkeypatch):
    base = L.Landmarks.of([L.spectrum(t) for t in TEXTS[:6]])
    want = base.kernels(TEXTS)
    for name, value in (("_GRAMS", 7), ("_BATCH", 2), ("_PIECE", 5)):
        monkeypatch.setattr(L, name, value)
    assert np.abs(L.Landmarks.of([L.spectrum(t) for t in TEXTS[:6]]).kernels(TEXTS) - want).max() < 1e-6


def test_regression_is_kernel_ridge():
    """With all rows as landmarks Nyström is exact: the fit solves the weighted
    kernel ridge problem (no intercept moves it when the targets are centred)."""
    rng = np.random.default_rng(1)
    words = [["ka", "lo", "mi"], ["zu", "xe", "wo"]]
    texts = [" ".join("".join(rng.choice(words[k % 2], 2)) for _ in range(6)) for k in range(12)]
    langs = ["ab"[k % 2] for k in range(12)]
    base = L.Landmarks.of([L.spectrum(t) for t in texts])
    K = base.kernels(texts)
    model = L.fit(base, K, langs, ridge=0.1)
    # Minimise sum (f(x) - y)^2 / n + 0.1 |f|^2 with a free intercept, by the dual.
    n, y = len(texts), np.array([[float(a == b) for b in "ab"] for a in langs])
    A = np.block([[K + 0.1 * n * np.eye(n), np.ones((n, 1))], [np.ones((1, n)), np.zeros((1, 1))]])
    dual = np.linalg.solve(A, np.vstack([y, np.zeros((1, 2))]))
    want = K @ dual[:n] + dual[n]
    assert np.abs(model.scores(texts) - want).max() < 1e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    out = {r["doc_id"]: r for r in got.collect()}
    assert len(out) == docs.count()
    for i, r in out.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r["lang"] == r["lang_pred"] for r in out.values() if r["held_out"] and r["lang"] is not None]
    assert np.mean(held) > 0.95


def test_inputs_are_the_text_alone(spark):
    """Languages of held-out rows, sources and the order of rows change nothing."""
    docs = spark.read.parquet(f"{H.SF}/documents.parquet")
    other = docs.withColumn("lang", F.when(L.in_training_fold(F.col("doc_id")), F.col("lang")).otherwise("xx")) \
        .withColumn("source", F.lit(None).cast("string")).repartition(7)
    a = {r[0]: r for r in L.languages(docs).collect()}
    b = {r[0]: r for r in L.languages(other).collect()}
    assert a.keys() == b.keys()
    assert all(a[i]["lang_pred"] == b[i]["lang_pred"] and abs(a[i]["score"] - b[i]["score"]) < 1e-4 for i in a)


def test_odd_rows(spark):
    docs = H.documents(spark).withColumn("told", F.lit(1)).withColumn("_place", F.lit(2))
    got = L.languages(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    out = got.collect()
    assert len(out) == docs.count()
    known = {r[0] for r in docs.where("lang IS NOT NULL").select("lang").distinct().collect()}
    assert {r["lang_pred"] for r in out} <= known | {"und"}
    by = {r["doc_id"]: r for r in out}
    for i in (1, 2, 3):
        assert by[i]["lang_pred"] == "und" and by[i]["score"] == 0
    assert by[4]["lang_pred"] != "und" and by[None]["held_out"] is False


def test_nothing_to_learn(spark):
    assert L.languages(H.nothing(spark)).collect() == []
    docs = spark.createDataFrame([(1, "abc", None, "a", 3), (None, "abc", "en", "a", 3), (2, "12", "en", "a", 2)], H.KIND)
    assert {r["lang_pred"] for r in L.languages(docs).collect()} == {"und"}


def test_one_language_and_a_long_text(spark):
    docs = spark.createDataFrame([(1, "word " * 400_000, "en", "a", 1), (3, "ein wort", "en", "a", 1),
                                  (4, "zwei", None, None, None)], H.KIND)
    assert {r["lang_pred"] for r in L.languages(docs).collect()} == {"en"}
