"""Per-group top-k and list nesting.

``row_number() <= k`` over a partitioned window is planned by Spark as a
``WindowGroupLimit`` on both sides of the shuffle: every map task keeps at
most k rows per group before exchanging, so a hot group (one key holding a
third of the rows) ships at most k rows per input partition, never the whole
group. The final window sorts only those survivors.

Ties on the ranking value are broken by the id columns given, ascending,
so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of every ``by`` group under ``order``,
    adding a 1-based ``rank_col``."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def latest(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every group under ``order`` (no rank column)."""
    return top_k(df, by, order, 1, "_latest_rank").drop("_latest_rank")


def nest_ranked(df: DataFrame, by: Sequence[str], rank_col: str, fields: dict[str, str],
                out: str = "recs") -> DataFrame:
    """Collect already-limited ranked rows into one ordered array per group.

    Must only be used after ``top_k`` (bounded groups). ``fields`` maps output
    struct field names to source columns.
    """
    items = F.struct(F.col(rank_col).alias("_r"),
                     *[F.col(src).alias(name) for name, src in fields.items()])
    nested = df.groupBy(*by).agg(F.array_sort(F.collect_list(items)).alias("_items"))
    keep = list(fields)
    return nested.select(*by, F.transform(
        "_items", lambda x: F.struct(*[x[n].alias(n) for n in keep])).alias(out))


def flatten_ranked(df: DataFrame, by: Sequence[str], array_col: str = "recs",
                   rank_col: str = "rank") -> DataFrame:
    """Inverse of ``nest_ranked``: one row per list element with its 1-based
    position."""
    x = df.select(*by, F.posexplode(array_col).alias("_pos", "_item"))
    return x.select(*by, (F.col("_pos") + 1).alias(rank_col), "_item.*")
