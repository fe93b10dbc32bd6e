"""Rating statistics kept up to date batch by batch.

Counts and averages are algebraic, so a batch of ratings is stored once as partial
aggregates per item and month, and the statistics are sums over these (far fewer) rows
instead of a scan of the history:

    <path>/deltas/batch_id=<b>/         partial aggregates of one batch
    <path>/snapshots/version=<v>/       their sum over some batches
    <path>/covered/version=<v>/         which batches those are

A batch is written with overwrite, so writing it again changes nothing, and sums don't
depend on the order of batches. ``fold`` sums what there is into a new snapshot and
lists the batches in it, as these need not be consecutive; a batch that is in the
snapshot is not read again, so one that arrives again (a replay) does not count twice.
The list is written after the snapshot, and readers take the highest version that has a
finished list: a fold that fails half-way is not seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratings_spark.functions.dates import year_month
from ratings_spark.session import list_folder

DELTA_SCHEMA = "mid bigint, yearmonth bigint, n bigint, n_scored bigint, total double"


def partial_aggregates(ratings: DataFrame) -> DataFrame:
    """(mid, yearmonth, n, n_scored, total): rows, scored rows and sum of scores."""
    return ratings.select(F.col("mid").cast("long").alias("mid"), year_month("timestamp").alias("yearmonth"), "score") \
        .groupBy("mid", "yearmonth") \
        .agg(F.count(F.lit(1)).alias("n"), F.count("score").alias("n_scored"),
             F.sum(F.col("score").cast("double")).alias("total"))


def write_batch(ratings: DataFrame, path: str, batch_id: int) -> None:
    """Store one batch of ratings (uid, mid, score, timestamp)."""
    partial_aggregates(ratings).write.mode("overwrite").parquet(f"{path}/deltas/batch_id={int(batch_id)}")


def batch_writer(path: str):
    """``foreachBatch`` body of a stream of ratings."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)
    return write


def _numbers(spark: SparkSession, folder: str, tag: str) -> list[int]:
    """Numbers of the finished folders ``<tag>=<number>`` of a folder."""
    names = [x[len(tag) + 1:] for x in list_folder(spark, folder) if x.startswith(f"{tag}=")]
    return sorted(int(x) for x in names if "_SUCCESS" in list_folder(spark, f"{folder}/{tag}={x}"))


def _state(spark: SparkSession, path: str) -> tuple[int | None, set[int], list[int]]:
    """Newest snapshot (if any), the batches in it, and the batches after it."""
    versions = _numbers(spark, f"{path}/covered", "version")
    version = versions[-1] if versions else None
    covered = set()
    if version is not None:
        # One row a batch: as many as there are folders to list.
        rows = spark.read.parquet(f"{path}/covered/version={version}").toLocalIterator()
        covered = {r["batch_id"] for r in rows}
    return version, covered, [b for b in _numbers(spark, f"{path}/deltas", "batch_id") if b not in covered]


def _summed(spark: SparkSession, path: str, version: int | None, batches: list[int]) -> DataFrame:
    paths = [f"{path}/deltas/batch_id={b}" for b in batches]
    if version is not None:
        paths.append(f"{path}/snapshots/version={version}")
    if not paths:
        return spark.createDataFrame([], DELTA_SCHEMA)
    return spark.read.schema(DELTA_SCHEMA).parquet(*paths).groupBy("mid", "yearmonth") \
        .agg(*[F.sum(c).alias(c) for c in ("n", "n_scored", "total")])


def current(spark: SparkSession, path: str) -> DataFrame:
    """The partial aggregates of all batches, one row an item and month."""
    version, _, batches = _state(spark, path)
    return _summed(spark, path, version, batches)


def fold(spark: SparkSession, path: str) -> int | None:
    """Sum all batches into a new snapshot; returns its version, the old one if no
    batch is new. Older folders stay (their removal is a retention policy)."""
    version, covered, batches = _state(spark, path)
    if not batches:
        return version
    new = 0 if version is None else version + 1
    _summed(spark, path, version, batches).write.mode("overwrite").parquet(f"{path}/snapshots/version={new}")
    spark.createDataFrame([(b,) for b in sorted(covered | set(batches))], "batch_id bigint") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/covered/version={new}")
    return new


def rating_counts(state: DataFrame) -> DataFrame:
    """(mid, count), as ``stats.rating_counts`` of all ratings (unordered)."""
    return state.groupBy("mid").agg(F.sum("n").alias("count"))


def monthly_counts(state: DataFrame) -> DataFrame:
    """(mid, count, yearmonth), as ``stats.monthly_counts`` of all ratings (unordered)."""
    return state.select("mid", F.col("n").alias("count"), "yearmonth")


def average_scores(state: DataFrame) -> DataFrame:
    """(mid, avg), as ``stats.average_scores`` of all ratings."""
    return state.groupBy("mid").agg(F.try_divide(F.sum("total"), F.sum("n_scored")).alias("avg"))
