"""Best-fit packing of token sequences, matched on a histogram of lengths.

Documents are tokenised and cut into pieces of at most ``SEQUENCE`` tokens (a
long document's first piece takes the odd length), then packed best-fit
decreasing: longest pieces first, each into the smallest gap that takes it.

Lengths are whole numbers up to SEQUENCE, so both sides are runs of equal
lengths, and a superstep treats a whole run: all pieces of one length look up
their successor among the gaps, conflicts are resolved by rank (the j-th piece
of the run goes to the j-th place of the gap run), the used gaps shrink, and the
next shorter length follows. Three steps:

1. pieces are range-sorted by length and get their rank within their length
   (counted by range partition, so a length that holds most pieces is spread
   over many tasks);
2. ``sweep`` runs the supersteps over the run table, one after the other on the
   driver, not as distributed sweeps: pieces of one length and bins of one gap are
   interchangeable, so the histogram gives the same packing. Its state is bounded by
   SEQUENCE, not by the input: at most SEQUENCE piece runs, and a gap run is
   split at most twice in a superstep;
3. every piece finds its run of assignments by (length, rank) in parallel.

Defined results: null text is an empty text (only the end id); rows are packed
one for one, repeated rows, null and repeated ids included; an empty table
gives no pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from ..session import materialize, ship_package
from .common import text_of

SEQUENCE = 1024
VOCABULARY, RANKS, END = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", 2


# --- tokens -----------------------------------------------------------------

_ENCODERS: dict = {}
# tiktoken's pattern steps back through a run of white space on the stack, which
# gives out near a million characters; such texts go through the library.
_LONG_SPACE = 20_000
_SPACES = re.compile(r"\s{%d}" % _LONG_SPACE)


def _path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(vocabulary: str = VOCABULARY, ranks: str | None = RANKS):
    """A function from texts to their ids as the tokenizers library gives them
    for ``vocabulary``. With ``ranks``, the same vocabulary in tiktoken's form,
    ordinary text is encoded by tiktoken, which gives the same ids in a third of
    the time; the special token's string is replaced as the library does it."""
    if (vocabulary, ranks) not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(_path(vocabulary))

        def library(texts):
            return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
        if ranks is None:
            _ENCODERS[vocabulary, ranks] = library
        else:
            import base64
            import json

            import public_tokenizers
            import tiktoken
            with open(_path(ranks), "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            with open(_path(vocabulary), encoding="utf-8") as f:
                added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
            tk = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                   special_tokens=added)

            def one(t):
                if len(t) > _LONG_SPACE and _SPACES.search(t):
                    return library([t])[0]
                return tk.encode(t, allowed_special="all") if any(map(t.__contains__, added)) \
                    else tk.encode_ordinary(t)

            def encode(texts):
                return list(map(one, texts))
            _ENCODERS[vocabulary, ranks] = encode
    return _ENCODERS[vocabulary, ranks]


def _cut(vocabulary: str, ranks: str | None, end: int, sequence: int):
    def run(batches):
        encode = encoder(vocabulary, ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = part.column(0).to_pylist()
                rows: list[list] = [[], [], [], [], []]
                for k, tokens in enumerate(encode(part.column(1).to_pylist())):
                    tokens = np.array([*tokens, end], "<u4")
                    first = (len(tokens) - 1) % sequence + 1
                    starts = [0, *range(first, len(tokens), sequence)]
                    for piece, start in enumerate(starts):
                        stop = start + sequence if piece else first
                        body = tokens[start:stop]
                        for column, v in zip(rows, (ids[k], piece, start, len(body), zlib.crc32(body.tobytes()))):
                            column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], part.column(0).type), pa.array(rows[1], pa.int32()),
                     *[pa.array(r, pa.int64()) for r in rows[2:]]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, ranks: str | None = RANKS, end: int = END,
           sequence: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of all pieces."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", text_of(docs).alias("text"))
            .mapInArrow(_cut(vocabulary, ranks, end, sequence),
                        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"))


# --- matching ---------------------------------------------------------------

def sweep(counts: dict[int, int], sequence: int = SEQUENCE) -> np.ndarray:
    """Best-fit over runs. ``counts``: number of pieces by length. Returns rows
    (length, first rank, pieces a bin, first bin, offset in bin), sorted: piece
    r of the length goes to bin ``first bin + (r - first rank) // a_bin``."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of bins [lo, hi)
    sizes: list[int] = []                        # the gaps there are, sorted
    out, bins = [], 0

    def add(gap, lo, hi):
        if gap and hi > lo:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((lo, hi))

    for length in sorted(counts, reverse=True):
        rank, n = 0, counts[length]
        while rank < n:
            k = bisect_left(sizes, length)
            if k < len(sizes):  # the successor: the smallest gap that is large enough
                gap = sizes[k]
                lo, hi = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[k]
            else:               # no gap takes it: new bins, as many as this run fills
                gap = sequence
                lo, hi = bins, bins - -(n - rank) // (sequence // length)
                bins = hi
            each = gap // length
            take = min(n - rank, each * (hi - lo))
            out.append((length, rank, each, lo, sequence - gap))
            full, odd = divmod(take, each)
            add(gap - each * length, lo, lo + full)
            if odd:
                add(gap - odd * length, lo + full, lo + full + 1)
            add(gap, lo + full + (odd > 0), hi)
            rank += take
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def _number(batches):
    """Adds the range partition and the rank within its length there. Rows come
    sorted by length."""
    part, length, rank = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        lengths = batch.column(batch.schema.get_field_index("length")).to_numpy()
        begins = np.flatnonzero(np.concatenate(([True], lengths[1:] != lengths[:-1]))) if len(lengths) else []
        ranks = np.arange(len(lengths), dtype=np.int64)
        for a, b in zip(begins, [*begins[1:], len(lengths)]):
            if lengths[a] != length:
                length, rank = lengths[a], 0
            ranks[a:b] += rank - a
            rank += int(b - a)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(lengths), part, np.int32)), pa.array(ranks)],
            names=[*batch.schema.names, "part", "rank"])


def _place(plan: np.ndarray):
    def run(batches):
        keys = plan[:, 0] * (1 << 44) + plan[:, 1]
        for batch in batches:
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy()
            rank = batch.column(names.index("rank")).to_numpy()
            row = plan[np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1]
            step = rank - row[:, 1]
            bins, slot = row[:, 3] + step // row[:, 2], step % row[:, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(bins), pa.array(row[:, 4] + slot * length)],
                names=[*names[:5], "sequence_id", "offset"])
    return run


def pack(cut: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Adds sequence_id and offset to ``pieces``."""
    spark = cut.sparkSession
    ship_package(spark)
    cut = materialize(cut, "pack-pieces")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    order = [F.col("length").desc(), F.crc32(F.concat_ws(",", "doc_id", "piece", "ids_crc32").cast("binary")),
             "doc_id", "piece", "ids_crc32"]
    ranked = materialize(cut.repartitionByRange(*order).sortWithinPartitions(*order)
                         .mapInArrow(_number, f"{kinds}, part int, rank bigint"), "pack-ranked")
    # Runs: one row a length and range partition. Partitions are sorted by
    # length, so there are at most SEQUENCE + partitions of them.
    runs = ranked.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = (Window.partitionBy("length").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    runs = materialize(runs, "pack-runs")
    counts = {r["length"]: r["n"] for r in runs.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if not counts:
        return spark.createDataFrame([], f"{kinds}, sequence_id bigint, offset bigint")
    columns = cut.columns
    return (ranked.join(runs.select("length", "part", "before"), ["length", "part"])
            .select(*columns, (F.col("rank") + F.col("before")).alias("rank"))
            .mapInArrow(_place(sweep(counts, sequence)), f"{kinds}, sequence_id bigint, offset bigint"))


def pack_documents(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, **settings), settings.get("sequence", SEQUENCE))
