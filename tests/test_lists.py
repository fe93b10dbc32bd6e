"""Encoded recommendation lists and vector expressions."""

from hypothesis import given, settings, strategies as st

from ratings_spark.functions.lists import decode_recs, encode_recs
from ratings_spark.functions.vectors import cosine


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**12), st.floats(-1e6, 1e6, allow_nan=False)),
                max_size=20))
def test_encode_decode_roundtrip(spark, recs):
    df = spark.createDataFrame([(recs,)], "recs array<struct<mid:bigint,r:double>>")
    out = df.select(encode_recs("recs").alias("t")).select(decode_recs("t").alias("d")).first()["d"]
    assert [x["mid"] for x in out] == [m for m, _ in recs]
    assert [x["r"] for x in out] == [r for _, r in recs]   # in full, not to six digits


def test_decode_bad_and_empty(spark):
    df = spark.createDataFrame([("1:2.5| x : y |3",), ("",), (None,)], "t string")
    got = [r["d"] for r in df.select(decode_recs("t").alias("d")).collect()]
    assert [(x["mid"], x["r"]) for x in got[0]] == [(1, 2.5), (None, None), (3, None)]
    assert got[1] == [] and got[2] == []


def test_fixed_point_text(spark):
    df = spark.createDataFrame([([(1, 2.0), (2, 1 / 3)],)], "recs array<struct<mid:bigint,r:double>>")
    assert df.select(encode_recs("recs", 6)).first()[0] == "1:2.000000|2:0.333333"


def test_cosine_zero_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 1.0], [1.0, 1.0])],
                               "a array<double>, b array<double>")
    c = [r["c"] for r in df.select(cosine("a", "b").alias("c")).collect()]
    assert c[0] is None and abs(c[1] - 1.0) < 1e-12
