"""Replace-per-key tables kept as versions, and their compaction by key bucket.

A writer adds ``<root>/batch_id=<n>``; a key's current rows are those of its
highest batch. Compaction keeps read cost from growing with the batches:

    <root>_snapshots/data/through=<n>/uid_bucket=<b>      current rows of some buckets
    <root>_snapshots/manifest/through=<n>                 (buckets, uid_bucket, version)

A compaction merges only the buckets that hold keys of batches since the last one
and writes only those; the manifest, written last, says which folder holds each
bucket's rows, so a compaction that died leaves the former view. Data a manifest no
longer names is left in place for the operator's retention policy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratings_spark.operators import history, rerank
from ratings_spark.session import list_folder

MANIFEST = "buckets int, uid_bucket int, version bigint"


def _folders(root: str) -> tuple[str, str]:
    return f"{root}_snapshots/data", f"{root}_snapshots/manifest"


def _snapshot(spark: SparkSession, root: str) -> tuple[int, int | None, dict[int, int]]:
    """(batch the newest manifest covers, its number of buckets, version by bucket);
    (-1, None, {}) without one. Partition discovery lists committed files only. A
    manifest has one row a bucket."""
    folder = _folders(root)[1]
    if not any(x.startswith("through=") for x in list_folder(spark, folder)):
        return -1, None, {}
    rows = spark.read.schema(MANIFEST + ", through bigint").parquet(folder)
    through = rows.agg(F.max("through")).first()[0]
    if through is None:
        return -1, None, {}
    named = rows.where(F.col("through") == through).collect()
    return through, named[0]["buckets"], {r["uid_bucket"]: r["version"] for r in named}


def _read_buckets(spark: SparkSession, root: str, versions: dict[int, int]) -> DataFrame | None:
    if not versions:
        return None
    data = _folders(root)[0]
    paths = [f"{data}/through={v}/uid_bucket={b}" for b, v in sorted(versions.items())]
    return spark.read.option("basePath", data).parquet(*paths).drop("through", "uid_bucket")


def _latest(old: DataFrame | None, new: DataFrame) -> DataFrame:
    return rerank.latest_version(new if old is None else old.unionByName(new), "uid", "batch_id")


def current(spark: SparkSession, root: str) -> DataFrame:
    """Each key's rows of its highest batch: the buckets the manifest names, and
    the batches after it."""
    through, _, versions = _snapshot(spark, root)
    new = spark.read.parquet(root).where(F.col("batch_id") > through)
    return _latest(_read_buckets(spark, root, versions), new)


def compact(spark: SparkSession, root: str, buckets: int | None = None) -> int:
    """Fold the batches since the last compaction into the buckets they touch, and
    return the last batch covered (-1 if there is none). The number of buckets is set
    by the first compaction, from its rows or ``buckets``; a compaction of new batches
    that names another number rewrites all buckets."""
    through, n, versions = _snapshot(spark, root)
    new = spark.read.parquet(root).where(F.col("batch_id") > through)
    last = new.agg(F.max("batch_id")).first()[0]
    if last is None:
        return int(through)
    # A batch committed from here on belongs to the next compaction.
    new = new.where(F.col("batch_id") <= last)
    if n is None or buckets not in (None, n):
        n = buckets or history.bucket_count(new.count())
        merged, kept = versions, {}
    else:
        touched = set(history.bucket_id_sets(new, {"uid": ("uid", n)})["uid"])
        merged = {b: v for b, v in versions.items() if b in touched}
        kept = {b: v for b, v in versions.items() if b not in touched}
    data, manifest = _folders(root)
    _latest(_read_buckets(spark, root, merged), new) \
        .withColumn("uid_bucket", history.bucket_of("uid", n)).hint("rebalance", "uid_bucket") \
        .sortWithinPartitions("uid_bucket", "uid") \
        .write.mode("overwrite").partitionBy("uid_bucket").parquet(f"{data}/through={last}")
    tag = "uid_bucket="
    written = {int(x[len(tag):]): last for x in list_folder(spark, f"{data}/through={last}")
               if x.startswith(tag)}
    rows = [(n, b, v) for b, v in sorted({**kept, **written}.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1) \
        .write.mode("overwrite").parquet(f"{manifest}/through={last}")
    return int(last)
