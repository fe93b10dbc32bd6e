"""Block layout for exact all-pairs vector work.

Rows are hashed into ``B`` blocks. A block pair is one group of a grouped
``applyInPandas``/``cogroup`` call, so one task holds at most two blocks
(``block_rows`` vectors each) and computes their product with NumPy. Every
row is replicated once per partner block (``B`` copies), which is the whole
shuffle volume: O(n * B) rows, never O(n^2). Larger blocks mean fewer
copies; inside a task the product is taken in row chunks sized so that a
chunk's scores stay within ``CHUNK_SCORES`` (16 MB), whatever the block size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DEFAULT_BLOCK_ROWS = 32768
# Rows of the left block multiplied at once inside a task (at most), and the
# score-matrix size a chunk may reach: 2 M doubles = 16 MB, whatever the
# block size.
CHUNK_ROWS = 1024
CHUNK_SCORES = 2 * 1024 * 1024


def chunk_rows(n_right: int, max_rows: int = CHUNK_ROWS) -> int:
    """Left rows per chunk so a chunk's scores stay within CHUNK_SCORES."""
    return max(1, min(max_rows, CHUNK_SCORES // max(1, n_right)))


def block_count(spark: SparkSession, n_rows: int, block_rows: int | None,
                symmetric: bool) -> int:
    """Blocks so that each holds <= ``block_rows`` rows, and enough block
    pairs exist to occupy every core at least twice."""
    br = block_rows or DEFAULT_BLOCK_ROWS
    by_size = max(1, math.ceil(n_rows / br))
    cores = max(1, spark.sparkContext.defaultParallelism)
    # symmetric: B(B+1)/2 groups; rectangular: B*B' groups (B' similar).
    by_par = max(1, math.ceil(math.sqrt(2 * 2 * cores if symmetric else 2 * cores)))
    return max(by_size, min(by_par, max(1, n_rows)))


def block_of(id_col: str, n_blocks: int, salt: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(salt)), F.lit(n_blocks)).cast("int")


def replicate(df: DataFrame, n: int, name: str) -> DataFrame:
    """One copy of every row per partner block id 0..n-1."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


# Rows a partition of block pairs holds at most: some 256 MB of 64-wide floats.
PARTITION_ROWS = 1_000_000


def spread_groups(df: DataFrame, n_groups: int, n_rows: int, *cols: str) -> DataFrame:
    """Hash-partition the ``n_rows`` block-pair rows on the group columns, so
    that a partition holds about ``PARTITION_ROWS`` of them, in at least four
    partitions a core and at most one a group.

    The grouped pandas call reuses this partitioning (no second shuffle),
    and an explicit partition count is not coalesced by AQE. Without it, a
    small shuffle feeding CPU-heavy block products would be merged into a
    couple of tasks, leaving most cores idle.
    """
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    by_size = -(-n_rows // PARTITION_ROWS)
    return df.repartition(max(1, min(n_groups, max(by_size, 4 * cores))), *cols)


@dataclass(frozen=True)
class RangeBlock:
    """A block of rows whose keys lie between ``low`` and ``high``."""

    n: int
    low: float
    high: float


def range_blocks(df: DataFrame, key: str, n_rows: int, blocks: int,
                 id_col: str = "id") -> tuple[DataFrame, list[RangeBlock]]:
    """``df`` with its block ``b``, blocks being numbered by rising ``key`` (double),
    and the blocks. Borders are approximate quantiles; rows that share a key, of
    which a range can have any number, are dealt over several blocks of it by hash.
    ``df`` is read several times: give a written table."""
    probs = [k / blocks for k in range(1, blocks)]
    cuts = sorted(set(df.approxQuantile(key, probs, 0.2 / blocks))) if probs and n_rows else []
    if cuts:
        df = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol=key, outputCol="_range").transform(df)
    else:
        df = df.withColumn("_range", F.lit(0.0))
    # One row a range: at most ``blocks``.
    found = {int(r["_range"]): r for r in df.groupBy("_range").agg(
        F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()}
    size, first, out = max(1, -(-n_rows // blocks)), [], []
    for k in range(len(cuts) + 1):
        first.append(len(out))
        if k in found:
            r = found[k]
            parts = max(1, round(r["n"] / size))
            out += [RangeBlock(-(-r["n"] // parts), r["low"], r["high"])] * parts
    first.append(len(out))
    table = df.sparkSession.createDataFrame(
        [(float(k), first[k], first[k + 1] - first[k]) for k in range(len(cuts) + 1)],
        "_range double, _first int, _parts int")
    part = F.pmod(F.xxhash64(id_col, F.lit(3)), F.col("_parts")).cast("int")
    return df.join(table, "_range").withColumn("b", F.col("_first") + part).drop("_range", "_first", "_parts"), out
