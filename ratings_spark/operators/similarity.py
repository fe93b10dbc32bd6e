"""Item-item cosine similarity above a threshold, exact.

Unit-normalise once, hash items into blocks, one group per unordered block
pair (p <= q); each task multiplies two blocks with NumPy and emits only pairs
strictly above the threshold, in both directions. Each pair is computed once,
and most end after a few coordinates: both blocks are turned to their common
principal axes, which leaves every product as it is, and a pair whose product
over the first axes plus the product of the remaining norms can't pass the
threshold is not multiplied further (``first_axes``).

Output: directed edges (mid, other_mid, sim), no self pairs, sim > threshold.
The planner sizes a pandas function's output by its input, which for edges
can be a large underestimate; write the edges (``session.materialize`` or a
job's table) before joining them elsewhere.
"""

from __future__ import annotations

from typing import Any, Iterator, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ratings_spark.constants import SIM_THRESHOLD
from ratings_spark.functions.vectors import dot
from ratings_spark.operators.blocks import (
    CHUNK_ROWS, DEFAULT_BLOCK_ROWS, block_count, block_of, chunk_rows, replicate, spread_groups)
from ratings_spark.operators.topk import top_k
from ratings_spark.session import materialize, ship_package

EDGE_SCHEMA = "mid long, other_mid long, sim double"


# Axes tried first, and half as many more each time, until at most this share of a block
# pair's products is still open; pairs finished at once.
LEAST_AXES = 4
OPEN_SHARE = 1 / 128
OPEN_PAIRS = 65_536


def _unit_rows(vs) -> np.ndarray:
    X = np.vstack(vs).astype(np.float64)
    return X / np.sqrt(np.einsum("ij,ij->i", X, X))[:, None]


def principal_axes(X: np.ndarray, Y: np.ndarray) -> np.ndarray:
    """Orthogonal axes (columns) of the two blocks together, greatest second moment first."""
    return np.linalg.eigh(X.T @ X + Y.T @ Y)[1][:, ::-1]


def bounded_rows(X: np.ndarray, axes: np.ndarray, m: int) -> np.ndarray:
    """Coordinates on the first ``m`` axes, then the norm of what they leave out, in
    single precision. The product of two such rows is at least that of the vectors
    (Cauchy-Schwarz), but for ``slack``."""
    head = X @ axes[:, :m]
    rest = np.einsum("ij,ij->i", X, X) - np.einsum("ij,ij->i", head, head)
    return np.column_stack([head, np.sqrt(np.maximum(rest, 0.0))]).astype(np.float32)


def slack(d: int) -> float:
    """More than single precision can be off in a product of unit vectors of ``d`` coordinates."""
    return (d + 8) * 1.2e-7


def first_axes(X: np.ndarray, Y: np.ndarray, axes: np.ndarray, threshold: float) -> int:
    """How many axes leave at most ``OPEN_SHARE`` of the products open, judged by evenly
    spaced rows of both blocks; 0 if all axes leave more, so that products are best taken
    whole. The edges are the same whatever it says."""
    d = X.shape[1]
    xs, ys = X[::max(1, len(X) // 256)], Y[::max(1, len(Y) // 256)]
    m = min(LEAST_AXES, d)
    while True:
        bound = bounded_rows(xs, axes, m) @ bounded_rows(ys, axes, m).T
        if (bound > threshold - slack(d)).mean() <= OPEN_SHARE:
            return m
        if m == d:
            return 0
        m += max(LEAST_AXES, m // 2)
        m = m if m <= 3 * d // 4 else d


def _above(X: np.ndarray, Y: np.ndarray, threshold: float, same: bool):
    """(i, j, product) of the pairs above the threshold, in bounded pieces; with
    ``same`` each unordered pair once, no self pairs."""
    axes = principal_axes(X, Y)
    m = first_axes(X, Y, axes, threshold)
    A, B = (bounded_rows(X, axes, m), bounded_rows(Y, axes, m)) if m else (X, Y)
    least = np.float32(threshold - slack(X.shape[1])) if m else threshold
    step = chunk_rows(len(Y), CHUNK_ROWS)
    for lo in range(0, len(X), step):
        S = A[lo:lo + step] @ B.T
        keep = S > least
        if same:
            keep &= np.arange(len(Y))[None, :] > np.arange(lo, lo + len(S))[:, None]
        at = np.flatnonzero(keep)
        if not m:
            if len(at):
                yield lo + at // len(Y), at % len(Y), S.ravel()[at]
            continue
        for k in range(0, len(at), OPEN_PAIRS):
            a, b = lo + at[k:k + OPEN_PAIRS] // len(Y), at[k:k + OPEN_PAIRS] % len(Y)
            sim = np.einsum("ij,ij->i", X[a], Y[b])
            sure = sim > threshold
            if sure.any():
                yield a[sure], b[sure], sim[sure]


def _pair_block_fn(threshold: float):
    """Grouped-map function (iterator form) for one block pair (p, q).

    The group's input is two blocks (bounded by the block size); the output
    is yielded one piece at a time, so even a low threshold that keeps
    most pairs never holds more than one row chunk's edges in memory."""

    def fn(key: Tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True)
        p, q = int(key[0]), int(key[1])
        left = pdf[pdf["b"] == p]
        right = left if p == q else pdf[pdf["b"] == q]
        if left.empty or right.empty:
            return
        X = _unit_rows(left["v"].to_numpy())
        Y = X if p == q else _unit_rows(right["v"].to_numpy())
        xid = left["id"].to_numpy(np.int64)
        yid = right["id"].to_numpy(np.int64)
        for i, j, sim in _above(X, Y, threshold, p == q):
            yield pd.DataFrame({"mid": np.concatenate([xid[i], yid[j]]),
                                "other_mid": np.concatenate([yid[j], xid[i]]),
                                "sim": np.concatenate([sim, sim])})
    return fn


def _nearest_pivot_fn(pivots: np.ndarray):
    """Map function: each vector's nearest pivot and the angle to it."""
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if b.empty:
                continue
            X = np.vstack(b["v"].to_numpy()).astype(np.float64)
            X /= np.sqrt(np.einsum("ij,ij->i", X, X))[:, None]
            S = X @ pivots.T
            cell = S.argmax(axis=1)
            angle = np.arccos(np.clip(S[np.arange(len(S)), cell], -1, 1))
            yield b.assign(cell=cell.astype("int32"), angle=angle)
    return fn


def near_cells(pivots: np.ndarray, radius: np.ndarray, threshold: float) -> np.ndarray:
    """Which cells may hold a pair above the threshold: by the triangle
    inequality the angle between two vectors is at least that between their
    pivots less both cells' radii."""
    between = np.arccos(np.clip(pivots @ pivots.T, -1, 1))
    least = between - radius[:, None] - radius[None, :]
    return least <= np.arccos(np.clip(threshold, -1, 1)) + 1e-6


def _pivot_blocks(uv: DataFrame, threshold: float, block_rows: int | None,
                  pivots: int) -> tuple[DataFrame, int, int]:
    """Block copies (p, q, b, id, v) with blocks cut from the cells of
    ``pivots`` vectors (chosen by hash), copied only to the blocks of cells
    near their own; the number of groups and of copies."""
    spark = uv.sparkSession
    some = uv.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").collect()
    if not some:
        return uv.selectExpr("0 AS p", "0 AS q", "0 AS b", "id", "v"), 1, 1
    P = np.array([r["v"] for r in some], np.float64)
    P /= np.sqrt(np.einsum("ij,ij->i", P, P))[:, None]
    kind = uv.schema["v"].dataType.simpleString()
    cells = materialize(uv.mapInPandas(_nearest_pivot_fn(P), f"id long, v {kind}, cell int, angle double"),
                        "cells")
    n, radius = np.zeros(len(P), np.int64), np.zeros(len(P))
    for r in cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("r")).collect():
        n[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    parts = -(-n // (block_rows or DEFAULT_BLOCK_ROWS))   # a large cell has several blocks
    first = np.cumsum(parts) - parts
    near = near_cells(P, radius, threshold) & (n > 0)[:, None] & (n > 0)[None, :]
    table = spark.createDataFrame(
        [(int(a), int(first[a]), int(parts[a]), int(first[b]), int(parts[b])) for a, b in zip(*np.nonzero(near))],
        "cell int, first int, parts int, o_first int, o_parts int")
    x = cells.join(table, "cell").select(
        (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).alias("b"), "id", "v",
        F.explode(F.expr("sequence(o_first, o_first + o_parts - 1)")).alias("o"))
    per_cell = near.astype(np.int64) @ parts
    groups = int((near.astype(np.int64) * parts[:, None] * parts[None, :]).sum() + parts.sum()) // 2
    return x.select(F.least("b", "o").alias("p"), F.greatest("b", "o").alias("q"), "b", "id", "v"), \
        max(1, groups), int((n * per_cell).sum())


def item_similarity(factors: DataFrame, threshold: float = SIM_THRESHOLD,
                    block_rows: int | None = None, id_col: str = "id",
                    vec_col: str = "features", pivots: int = 0) -> DataFrame:
    """Directed similarity edges (mid, other_mid, sim) with sim > threshold.
    Of several vectors of one id the greatest, in array order, stands.

    With ``pivots`` blocks are cut by nearest pivot instead of by hash, and
    block pairs whose angle can't reach the threshold are skipped: the same
    edges, for one more pass over the vectors. It pays where vectors cluster
    (learnt factors) and there are many blocks."""
    spark = factors.sparkSession
    ship_package(spark)
    # Vectors travel in their stored precision (float for ALS factors): every
    # row is copied once per block, so this halves the shuffle. Zero, NULL and
    # NaN-bearing vectors are dropped JVM-side; each task normalises its two
    # blocks in double precision.
    n2 = dot(vec_col, vec_col)
    uv = factors.where(F.col(vec_col).isNotNull() & (n2 > 0) & ~F.isnan(n2)) \
        .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    uv = uv.groupBy("id").agg(F.max("v").alias("v"))
    if pivots:
        blocked, groups, copies = _pivot_blocks(uv, threshold, block_rows, pivots)
        blocked = spread_groups(blocked, groups, copies, "p", "q")
        return blocked.groupBy("p", "q").applyInPandas(_pair_block_fn(threshold), EDGE_SCHEMA)
    # Block sizing needs only an upper bound: the raw row count (read from
    # file footers for parquet) avoids running the filter and de-dup twice.
    n = factors.count()
    B = block_count(spark, n, block_rows, symmetric=True)
    blocked = replicate(uv.withColumn("b", block_of("id", B)), B, "o")
    blocked = blocked.select(F.least("b", "o").alias("p"), F.greatest("b", "o").alias("q"),
                             "b", "id", "v")
    blocked = spread_groups(blocked, B * (B + 1) // 2, n * B, "p", "q")
    return blocked.groupBy("p", "q").applyInPandas(_pair_block_fn(threshold), EDGE_SCHEMA)


def neighbour_stats(edges: DataFrame) -> DataFrame:
    """(mid, n_neighbours, min_sim, max_sim) per item."""
    return edges.groupBy("mid").agg(F.count(F.lit(1)).alias("n_neighbours"),
                                    F.min("sim").alias("min_sim"), F.max("sim").alias("max_sim"))


def neighbour_lists(edges: DataFrame, k: int | None = None) -> DataFrame:
    """Each item's neighbours by similarity, highest first, ties by id.

    With ``k``: (mid, rank, other_mid, sim), at most k per item (map-side
    limited). Without: every neighbour above the threshold, as the original
    stored them, as a globally sorted edge table (mid, other_mid, sim). The
    range-partitioned sort splits even a hot item's neighbours across tasks,
    so no single task holds an unbounded list; no rank column is produced.
    """
    order = [F.desc("sim"), F.asc("other_mid")]
    if k is None:
        return edges.select("mid", "other_mid", "sim").orderBy(F.asc("mid"), *order)
    return top_k(edges, ["mid"], order, k).select("mid", "rank", "other_mid", "sim")


def edges_from_nested(nested: DataFrame, key: str = "mid", recs: str = "recs") -> DataFrame:
    """(mid, other_mid, sim) edges from nested lists ``(mid, recs
    array<struct<mid, r>>)``; a neighbour listed twice for one item keeps
    one edge (the highest similarity)."""
    x = nested.select(F.col(key).alias("mid"), F.explode(recs).alias("_x"))
    e = x.select("mid", F.col("_x.mid").alias("other_mid"), F.col("_x.r").alias("sim"))
    return e.groupBy("mid", "other_mid").agg(F.max("sim").alias("sim"))
