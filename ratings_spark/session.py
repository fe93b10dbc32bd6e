"""Session construction and the shared scratch folder.

Library functions never build a session themselves; they take the caller's.
``build_session`` is a convenience for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. Adaptive execution re-plans joins and
# coalesces/splits shuffle partitions at run time (skewed join keys are split).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Per-user recent-ratings state lives in RocksDB so it can exceed memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ratings_spark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only when a local session names none (bare tests) is a private temporary
    folder created and registered as the checkpoint dir; on a cluster other
    executors would not see it, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is not set; with master {master} it must name "
                             "a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ratings-spark-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/ratings_spark/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable (reliable checkpoint only)."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder (not of what lies below them) on any
    file system Spark reaches; none if there is no such folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [f.getPath().getName() for f in fs.listStatus(p)]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ratings_spark`` importable in Python workers on every executor.

    Operators that run Python in tasks (grouped pandas functions, the
    streaming state processor) pickle functions by module reference, so the
    package must be on the workers' path. It is zipped once per application
    and distributed with ``SparkContext.addPyFile`` (as ``--py-files`` would).
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    zpath = os.path.join(tempfile.mkdtemp(prefix="ratings-spark-pyfiles-"), "ratings_spark.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            if "__pycache__" in root:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def materialize(df, name: str):
    """Write ``df`` as parquet below the shared checkpoint folder and return
    the re-read table.

    Used for outputs of pandas functions whose size the planner can only
    guess from their input (e.g. similarity edges): the re-read table has
    real file statistics, so join strategies are chosen from measured sizes,
    the lineage is cut, and the data is computed once for several consumers.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def release_unused(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that nothing refers to any more.

    It does so when the driver's garbage collector finds them gone, which on a driver
    that makes few objects can take many jobs; until then their files take disk."""
    spark.sparkContext._jvm.System.gc()
