"""Exact dedup through content-defined chunk recipes.

Each text is cut into chunks where a rolling hash over its last 16 bytes hits a
mask, so equal passages are cut alike wherever they stand. Two passes follow:

1. ``dictionary``: the distinct chunks, shuffled once with their bytes. Chunks
   with one 64-bit hash but different bytes are found here, and get identifiers
   that tell them apart; every other chunk is identified by its hash alone.
2. ``recipes``: each text as the ordered list of its chunks' identifiers. Texts
   are equal exactly when their lists are equal, so only these short lists are
   shuffled and compared, not the texts.

Defined results: a null text is an empty text; an empty text is a recipe
without chunks, so all empty texts are one group. Of equal texts the row with
the largest doc_id stays (null below any number); of rows that repeat a doc_id
and its text exactly one stays. An empty table gives an empty table. Columns
besides doc_id and text never meet the operator's own names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .common import text_of

MIN_CHUNK, MEAN_CHUNK, MAX_CHUNK = 256, 1024, 8192
_WINDOW = 16
_HASH_SEED = 42


def _gear_table() -> np.ndarray:
    """256 fixed pseudo-random 32-bit values, one a byte value."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)


def cut_points(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """End positions of the chunks of each text. ``data`` holds the UTF-8 bytes
    of all texts in a row, ``offsets`` their borders. A cut stands where the
    rolling hash hits, MIN_CHUNK to MAX_CHUNK bytes after the last, and never
    inside a character. The window lies within the chunk, as it is shorter."""
    h = _gear_table()[data]
    step = 1
    while step < _WINDOW:  # h[i] = sum of table[data[i - k]] << k for k < 2 * step
        later = h.copy()
        later[step:] += h[:-step] << np.uint32(step) if len(h) > step else 0
        h, step = later, step * 2
    hits = np.flatnonzero(h >> np.uint32(32 - MEAN_CHUNK.bit_length() + 1) == 0) + 1
    hits = hits[hits < len(data)]
    hits = hits[(data[hits] & 0xC0) != 0x80]
    first = np.searchsorted(hits, offsets)
    hits = hits.tolist()
    out = []
    for k in range(len(offsets) - 1):
        begin, end, ends = int(offsets[k]), int(offsets[k + 1]), []
        if end - begin > MIN_CHUNK:
            at, last = begin, int(first[k + 1])
            j = int(first[k])
            while end - at > MIN_CHUNK:
                while j < last and hits[j] < at + MIN_CHUNK:
                    j += 1
                cut = hits[j] if j < last else end
                if cut - at > MAX_CHUNK:
                    cut = at + MAX_CHUNK
                    while (data[cut] & 0xC0) == 0x80:
                        cut -= 1
                if cut >= end:
                    break
                ends.append(cut)
                at = cut
        if end > begin:
            ends.append(end)
        out.append(ends)
    return out


def _chunked(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Row number and chunks of each text of a string or binary array."""
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    view = data.tobytes()
    for k, ends in enumerate(cut_points(data, offsets)):
        at, chunks = int(offsets[k]), []
        for end in ends:
            chunks.append(view[at:end])
            at = end
        yield k, chunks


def _identity(chunk: bytes) -> int:
    """Signed 64-bit hash of a chunk."""
    h = xxhash.xxh64_intdigest(chunk, _HASH_SEED)
    return h - (1 << 64) if h >> 63 else h


SLICE_BYTES = 4 << 20


def _slices(texts: pa.Array, size: int = SLICE_BYTES):
    """Parts of an array of texts of at most ``size`` bytes, or one text: the
    chunker's arrays take some ten times the bytes of the texts."""
    at, held = 0, 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if held and held + n > size:
            yield texts.slice(at, k - at)
            at, held = k, 0
        held += n
    yield texts.slice(at)


def _emit_chunks(identity):
    def run(batches):
        for batch in batches:
            for texts in _slices(batch.column(0)):
                seen: dict[bytes, int] = {}
                for _, chunks in _chunked(texts):
                    for c in chunks:
                        if c not in seen:
                            seen[c] = identity(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen.values(), pa.int64()), pa.array(seen.keys(), pa.binary())],
                    names=["h", "chunk"])
    return run


def _recipe_column(identity, with_chunks: bool):
    """Column function: the recipe of a text. With ``with_chunks`` it lists
    (hash, chunk) pairs instead of hashes."""
    @F.arrow_udf("array<struct<h: bigint, chunk: binary>>" if with_chunks else "array<bigint>")
    def recipe(texts: pa.Array) -> pa.Array:
        kind = pa.struct([("h", pa.int64()), ("chunk", pa.binary())]) if with_chunks else pa.int64()
        parts = [pa.array([[(identity(c), c) if with_chunks else identity(c) for c in chunks]
                           for _, chunks in _chunked(part)], pa.list_(kind)) for part in _slices(texts)]
        return pa.concat_arrays(parts)
    return recipe


def dictionary(docs: DataFrame, identity=_identity) -> DataFrame:
    """The distinct chunks of all texts: (h, chunk)."""
    ship_package(docs.sparkSession)
    return (docs.select(text_of(docs).alias("text"))
            .mapInArrow(_emit_chunks(identity), "h long, chunk binary")
            .distinct())


def ambiguous(docs: DataFrame, identity=_identity) -> DataFrame:
    """Chunks whose hash stands for more than one byte string, each with a
    number of its own: (h, chunk, no). Written out, as it is read twice."""
    chunks = dictionary(docs, identity)
    shared = materialize(chunks.groupBy("h").count().where("count > 1").select("h"),
                         "dedup-shared-hashes")
    if shared.isEmpty():
        return docs.sparkSession.createDataFrame([], "h long, chunk binary, no int")
    numbered = (dictionary(docs, identity).join(shared, "h", "left_semi")
                .withColumn("no", F.row_number().over(Window.partitionBy("h").orderBy("chunk"))))
    return materialize(numbered, "dedup-ambiguous")


def recipes(docs: DataFrame, carried: dict, identity=_identity) -> DataFrame:
    """The ``carried`` columns of each row with its ``recipe``: the ordered
    identifiers of its chunks, equal exactly for equal texts."""
    ship_package(docs.sparkSession)
    other = ambiguous(docs, identity)
    if other.isEmpty():  # only texts go through Python
        return docs.select(*[c.alias(n) for n, c in carried.items()],
                           _recipe_column(identity, False)(text_of(docs)).alias("recipe"))
    # Some hash is shared: chunks take (hash, number) instead, looked up by
    # their bytes. Texts travel as chunks here; with 64-bit hashes this comes
    # up once in some ten billion distinct chunks.
    rows = docs.select(text_of(docs).alias("text"), F.struct(*[c.alias(n) for n, c in carried.items()]).alias("row"),
                       F.expr("uuid()").alias("id"))
    rows = materialize(rows, "dedup-rows")
    cut = rows.select("id", _recipe_column(identity, True)(F.col("text")).alias("recipe"))
    parts = cut.select("id", F.posexplode("recipe").alias("pos", "c")).select("id", "pos", "c.*")
    lists = (parts.join(other, ["h", "chunk"], "left")
             .groupBy("id")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "h", F.coalesce("no", F.lit(0)).alias("no"))))
                  .alias("parts"))
             .select("id", F.flatten(F.transform("parts", lambda p: F.array(p["h"], p["no"].cast("long"))))
                     .alias("recipe")))
    return (rows.join(lists, "id", "left")
            .select("row.*", F.coalesce("recipe", F.array().cast("array<bigint>")).alias("recipe")))


def duplicates(docs: DataFrame, identity=_identity) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256,
    n_chunks. Copies of a row are counted before they are shuffled, and the
    join brings each group's one row to its members, so a hot group of copies
    can be split."""
    rows = recipes(docs, {"doc_id": docs["doc_id"], "sha": F.sha2(text_of(docs), 256)}, identity)
    ids = rows.groupBy("recipe", "sha", "doc_id").agg(F.count("*").alias("n"))
    ids = materialize(ids, "dedup-recipes")
    groups = (ids.groupBy("recipe")
              .agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size")))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy")
    return (ids.join(groups, "recipe")
            .select("doc_id", "keep_id", "group_size", "sha", F.size("recipe").alias("n_chunks"), copies)
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    F.col("sha").alias("text_sha256"), "n_chunks"))


def keep_one(docs: DataFrame, identity=_identity) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Each text is
    shuffled once; copies meet before that in the map-side aggregation."""
    rows = recipes(docs, {"doc": F.struct(*[docs[f"`{c}`"] for c in docs.columns])}, identity)
    best = F.max_by("doc", F.struct(F.col("doc.doc_id").alias("id"),
                                    F.xxhash64("doc").alias("tie")))
    return rows.groupBy("recipe").agg(best.alias("doc")).select("doc.*")


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""
