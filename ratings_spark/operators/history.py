"""Per-user rating history: newest-N lists and the distinct user set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ratings_spark.constants import RECENT_RATINGS_N
from ratings_spark.operators.topk import top_k
from ratings_spark.session import list_folder


def recent_ratings(ratings: DataFrame, n: int = RECENT_RATINGS_N,
                   time_col: str = "timestamp", tiebreak: Sequence[str] = ()) -> DataFrame:
    """(uid, rank, mid, score): each user's ``n`` newest ratings, newest first.

    Exactly ``n`` (the original list read returned n+1 by an end-inclusive
    range). ``tiebreak`` columns, ascending, make the order total when
    timestamps repeat.
    """
    order = [F.desc(time_col)] + [F.asc(c) for c in tiebreak]
    return top_k(ratings, ["uid"], order, n).select("uid", "rank", "mid", "score")


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("uid").distinct()


def distinct_pairs(ratings: DataFrame) -> DataFrame:
    return ratings.select("uid", "mid").distinct()


# --- key-bucketed layout for per-batch lookups --------------------------------

# Rows a bucket holds when the number of buckets is chosen from the data.
BUCKET_ROWS = 2_000_000
MIN_BUCKETS = 16


def bucket_count(n_rows: int) -> int:
    """Buckets for a table of ``n_rows``: about ``BUCKET_ROWS`` in each."""
    return max(MIN_BUCKETS, -(-n_rows // BUCKET_ROWS))


def bucket_of(col: str, buckets: int):
    """Bucket of a key, the same for an int and a bigint."""
    return F.pmod(F.xxhash64(F.col(col).cast("string")), F.lit(buckets)).cast("int")


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Add ``<key>_buckets`` (their number) and ``<key>_bucket``, in this order
    the partition folders of a bucketed table: the number travels with it."""
    return df.withColumns({f"{key}_buckets": F.lit(buckets),
                           f"{key}_bucket": bucket_of(key, buckets)})


def clustered_by_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``with_bucket``, rebalanced by bucket before a partitioned write.

    A ``partitionBy`` write straight from the input would have every input
    task write a file into every bucket it meets (tasks x buckets files).
    ``REBALANCE`` clusters rows by bucket. AQE merges small partitions
    (several whole buckets per task) and splits skewed ones, such as a
    bucket holding a hot key, into advisory-size pieces. Each bucket thus
    gets few, reasonably sized files.
    """
    return with_bucket(df, key, buckets).hint("rebalance", f"{key}_bucket")


def write_by_bucket(df: DataFrame, path: str, key: str, buckets: int | None = None,
                    fmt: str = "parquet", options: dict | None = None,
                    mode: str = "overwrite") -> None:
    """Write ``df`` below ``<key>_buckets=<n>/<key>_bucket=<i>``, with few files
    per bucket and rows sorted by key within them (so that row groups can be
    skipped). Without ``buckets`` their number follows the row count; count
    a table that is costly to compute from its written form."""
    n = buckets or bucket_count(df.count())
    clustered_by_bucket(df, key, n).sortWithinPartitions(f"{key}_bucket", key) \
        .write.format(fmt).mode(mode).options(**(options or {})) \
        .partitionBy(f"{key}_buckets", f"{key}_bucket").save(path)


class BucketedTable:
    """A table written by ``write_by_bucket``, read one set of buckets at a
    time: only the named bucket folders are listed and scanned, so per-read
    cost follows the buckets asked for, not the table. Callable with no
    argument for the whole table.

    The number of buckets and the buckets there are come from the folder names
    at every ``layout`` call, so a table that was rewritten, with more
    buckets or another number of them, is read as it is now. A table that
    does not exist yet has no rows.
    """

    def __init__(self, spark, path: str, key: str, fmt: str = "parquet",
                 options: dict | None = None):
        self.spark, self.path, self.key, self.fmt = spark, path.rstrip("/"), key, fmt
        self.options = options or {}

    def __call__(self) -> DataFrame:
        return self.spark.read.format(self.fmt).options(**self.options).load(self.path)

    def layout(self) -> tuple[int | None, set[int]]:
        """(number of buckets, buckets that have a folder)."""
        counts = self._numbers(self.path, f"{self.key}_buckets=")
        if not counts:
            return None, set()
        if len(counts) > 1:
            raise ValueError(f"{self.path} holds layouts of {sorted(counts)} buckets")
        n = counts.pop()
        return n, self._numbers(f"{self.path}/{self.key}_buckets={n}", f"{self.key}_bucket=")

    def _numbers(self, folder: str, tag: str) -> set[int]:
        names = list_folder(self.spark, folder)
        return {int(x[len(tag):]) for x in names if x.startswith(tag)}

    def read(self, layout: tuple[int | None, set[int]], ids: list[int]) -> DataFrame | None:
        """Rows of the buckets ``ids`` of ``layout``; None if none has a folder."""
        n, present = layout
        folder = f"{self.path}/{self.key}_buckets={n}/{self.key}_bucket="
        paths = [f"{folder}{i}" for i in sorted(set(ids) & present)]
        if not paths:
            return None
        return self.spark.read.format(self.fmt).options(**self.options) \
            .option("basePath", self.path).load(paths)


def bucket_id_sets(df: DataFrame, keys: dict) -> dict:
    """Distinct bucket ids of several key columns in one job: ``{name: [ids]}``
    for ``keys = {name: (column, buckets)}``. A result has at most ``buckets``
    ids, whatever the size of ``df``."""
    if not keys:
        return {}
    row = df.agg(*[F.collect_set(bucket_of(c, n)).alias(str(k))
                   for k, (c, n) in enumerate(keys.values())]).first()
    return {name: sorted(row[k]) for k, name in enumerate(keys)}


# Bits of a sketch of keys, whatever their number (512 KB).
SKETCH_BITS = 1 << 22


def key_bit(col, bits: int = SKETCH_BITS):
    """Bit of a key in a sketch, the same for an int and a bigint."""
    return F.pmod(F.xxhash64(F.col(col).cast("string")), F.lit(bits))


def key_sketch(df: DataFrame, columns: Sequence[str], bits: int = SKETCH_BITS) -> list[int]:
    """The keys in ``columns`` of ``df`` as words of 64 bits, the bit of each key set:
    ``bits`` bits in all, whatever the size of ``df``."""
    found = df.select(F.explode(F.array_distinct(F.array(*[key_bit(c, bits) for c in columns]))).alias("bit"))
    word = found.groupBy(F.shiftright("bit", 6).cast("int").alias("word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("set"))
    words = [0] * -(-bits // 64)
    for r in word.collect():
        words[r["word"]] = r["set"]
    return words


def sketched(rows: DataFrame, key: str, words: Sequence[int]) -> DataFrame:
    """The ``rows`` whose ``key`` can be among the keys of a sketch: all that are, and
    of the others as small a share as the sketch has bits set. Rows are left out where
    they are read, before anything is sent."""
    table = rows.sparkSession.createDataFrame([(list(words),)], "words array<bigint>")
    bit = key_bit(key, 64 * len(words))
    word = F.get(table.scalar(), F.shiftright(bit, 6).cast("int"))
    return rows.where(F.getbit(word, bit.bitwiseAND(F.lit(63)).cast("int")) == 1)


def lookup(df: DataFrame, wanted: Sequence[tuple]) -> list[DataFrame]:
    """For each (tables, key columns of ``df``, columns to read): the rows of
    the tables that can match, in one job over ``df`` for the buckets and one for
    the sketch of each (``sketched``).

    ``tables`` is a ``BucketedTable`` or a list of them (read together), of
    which only the buckets of the keys in ``df`` are read and, as a bucket has many
    other keys, of these only rows that the keys' sketch has; or a callable
    giving a DataFrame, which is returned whole (the joins that follow
    select from it)."""
    plans = []
    for tables, columns, select in wanted:
        tables = tables if isinstance(tables, (list, tuple)) else [tables]
        plans.append([(t, t.layout() if isinstance(t, BucketedTable) else None, columns, select)
                      for t in tables])
    asked = {(i, j, c): (c, layout[0])
             for i, plan in enumerate(plans) for j, (_, layout, columns, _) in enumerate(plan)
             if layout is not None and layout[0] is not None for c in columns}
    ids = bucket_id_sets(df, asked)
    out = []
    for i, plan in enumerate(plans):
        parts, words = [], None
        for j, (table, layout, columns, select) in enumerate(plan):
            rows = table() if layout is None else table.read(
                layout, sorted({x for c in columns for x in ids.get((i, j, c), [])}))
            if rows is not None and layout is not None:
                if words is None:
                    words = key_sketch(df, columns)
                rows = sketched(rows, table.key, words)
            if rows is not None:
                parts.append(rows.select(*[F.col(c).cast(t).alias(c) for c, t in select]))
        empty = df.sparkSession.createDataFrame([], ", ".join(f"{c} {t}" for c, t in plan[0][3]))
        whole = parts[0] if parts else empty
        for p in parts[1:]:
            whole = whole.unionByName(p)
        out.append(whole)
    return out
