"""Maintained statistics against the batch statistics of all ratings."""

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from ratings_spark.operators import maintained as M
from ratings_spark.operators import stats
from ratings_spark.session import shared_dir
from ratings_spark.sources import adapters as A


@pytest.fixture(scope="module")
def ratings(spark):
    r = A.ratings(spark, SF_SMALL).select("uid", "mid", "score", "timestamp")
    odd = spark.createDataFrame([(1, 1, None, 10), (1, -5, None, 10), (2, -6, 3.0, None)],
                                "uid bigint, mid bigint, score double, timestamp bigint")
    return r.select(*[F.col(c).cast(t) for c, t in odd.dtypes]).union(odd) \
        .withColumn("batch", F.pmod(F.xxhash64("uid", "mid", "timestamp"), F.lit(5))).cache()


def same(spark, path, want):
    state = M.current(spark, path)
    key = lambda r: [(x is None, x) for x in r]
    for name in ("rating_counts", "monthly_counts", "average_scores"):
        got = [tuple(r) for r in getattr(M, name)(state).collect()]
        ref = [tuple(r) for r in getattr(stats, name)(want).collect()]
        for a, b in zip(sorted(got, key=key), sorted(ref, key=key), strict=True):
            assert a == b or all(x == y or abs(x - y) < 1e-9 for x, y in zip(a, b))


def test_replayed_out_of_order_and_folded_batches(spark, ratings):
    path = shared_dir(spark, "maintained")
    assert M.current(spark, path).collect() == [] and M.fold(spark, path) is None
    seen = []

    def write(b):
        M.write_batch(ratings.where(F.col("batch") == b).drop("batch"), path, b)
        seen.append(b)
        same(spark, path, ratings.where(F.col("batch").isin(*seen)).drop("batch"))
    for b in (3, 0, 3):          # out of order, and again before a fold
        write(b)
    assert M.fold(spark, path) == 0
    same(spark, path, ratings.where(F.col("batch").isin(*seen)).drop("batch"))
    for b in (1, 3, 4):          # a gap below, and again after the fold
        write(b)
    assert M.fold(spark, path) == 1 and M.fold(spark, path) == 1
    write(2)
    same(spark, path, ratings.drop("batch"))


def test_only_new_batches_and_the_snapshot_are_read(spark, ratings):
    path = shared_dir(spark, "maintained")
    for b in range(4):
        M.write_batch(ratings.where(F.col("batch") == b).drop("batch"), path, b)
    M.fold(spark, path)
    M.write_batch(ratings.where("batch = 4").drop("batch"), path, 4)
    read = {f.split("/")[-2] for f in M.current(spark, path).inputFiles()}
    assert read == {"version=0", "batch_id=4"}


def test_unfinished_fold_is_not_seen(spark, ratings):
    path = shared_dir(spark, "maintained")
    M.write_batch(ratings.where("batch = 0").drop("batch"), path, 0)
    want = rows(M.rating_counts(M.current(spark, path)))
    spark.createDataFrame([(1, 1, 9, 9, 9.0)], M.DELTA_SCHEMA).write.parquet(f"{path}/snapshots/version=0")
    assert rows(M.rating_counts(M.current(spark, path))) == want
    assert M.fold(spark, path) == 0
    assert rows(M.rating_counts(M.current(spark, path))) == want
