"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprint: ASCII letters lower-cased, words, shingles of ``shingle`` words
(repeats included) hashed with XXH64 (seed 42); a bit is 1 if it is set in over
half of the hashes.

Search: fingerprints within ``distance`` bits of each other have a common
variant within half that distance of both. Every distinct fingerprint emits all
its variants within that radius (65 for radius 1) and the rows meet on the
variant. For radius 1 a variant's row is two numbers however many fingerprints
meet there: a mask of the bits that lead back to them and a flag for the variant
itself, combined by bitwise or. So no group is ever gathered, and the
fingerprints are computed back from the mask, verified by their bit distance,
and linked in a star. Components run on distinct fingerprints only: copies share
one and are joined back at the end.

Defined results: null counts as empty; a text without words has fingerprint
zero and is linked like any other; fewer words than a shingle make one shingle
of all of them. Rows are one for one with the input, repeated rows included; a
null doc_id takes part, but names no component unless all ids of it are null.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .common import text_of
from .components import components

SHINGLE, DISTANCE, SEED = 3, 2, 42
BALL_ROWS = 2_000_000  # variants made by a task


_SLICE = 1 << 20  # bytes of a text whose words are held at once
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")


def _words(text: bytes):
    """Lists of the words of bounded parts of a text, cut at white space."""
    at = 0
    while at < len(text):
        end = _SPACE.search(text, at + _SLICE)
        stop = end.start() if end else len(text)
        yield text[at:stop].split()
        at = stop


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text. Votes of its parts add up; the last
    words of a part begin the first shingles of the next."""
    digest = xxhash.xxh64_intdigest
    votes, n, parts = np.zeros(64, np.int64), 0, []
    for more in _words(text.lower()):  # ASCII only, as the definition asks
        parts += more
        if len(parts) < shingle:
            continue
        joined = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        found = len(parts) - shingle + 1
        begins = np.concatenate(([0], ends[:-1]))[:found].tolist()
        stops = (ends[-found:] - 1).tolist()
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, stops)], "<u8")
        votes += _votes(h)
        n += found
        parts = parts[found:]
    if not n:
        if not parts:
            return 0
        votes, n = _votes(np.array([digest(b" ".join(parts), SEED)], "<u8")), 1
    return int(sum(1 << k for k in np.flatnonzero(2 * votes > n).tolist()))


def _votes(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        votes += np.unpackbits(h[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    return votes


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprint_column(shingle: int):
    """Column function: the signed fingerprint of a text."""
    @F.arrow_udf("bigint")
    def signed(texts: pa.Array) -> pa.Array:
        return pa.array([_signed(fingerprint(t.as_py() or b"", shingle)) for t in texts.cast(pa.large_binary())],
                        pa.int64())
    return signed


def fingerprints(docs: DataFrame, carried: dict, shingle: int = SHINGLE) -> DataFrame:
    """The ``carried`` columns of each row with ``fp``, the signed fingerprint.
    Only texts go through Python."""
    ship_package(docs.sparkSession)
    return docs.select(*[c.alias(n) for n, c in carried.items()],
                       _fingerprint_column(shingle)(text_of(docs)).alias("fp"))


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between distinct fingerprints, enough to connect all pairs
    within ``distance`` bits (1 or 2, as the radius of a ball is 1)."""
    if distance not in (1, 2):
        raise ValueError("ball hashing here has radius 1: distance 1 or 2")
    # Dealt by the rows they become, which adaptive execution can't foresee.
    tasks = max(fps.sparkSession.sparkContext.defaultParallelism, -(-65 * fps.count() // BALL_ROWS))
    ball = (fps.select("fp").distinct().repartition(tasks)
            .select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("bit"))
            .selectExpr("CASE WHEN bit = 64 THEN fp ELSE fp ^ shiftleft(1L, bit) END AS variant",
                        "CASE WHEN bit = 64 THEN 0L ELSE shiftleft(1L, bit) END AS flip",
                        "bit = 64 AS is_self"))
    met = (ball.groupBy("variant")
           .agg(F.bit_or("flip").alias("flips"), F.max("is_self").alias("is_self"))
           .where("bit_count(flips) + CAST(is_self AS INT) > 1"))
    members = F.expr("concat(IF(is_self, array(variant), CAST(array() AS array<bigint>)), "
                     "transform(filter(sequence(0, 63), k -> flips & shiftleft(1L, k) <> 0L), "
                     "k -> variant ^ shiftleft(1L, k)))")
    found = met.select(members.alias("m"))
    if distance == 2:  # any two of a ball's fingerprints are within 2 bits
        pairs = found.select(F.array_min("m").alias("a"), F.explode("m").alias("b"))
    else:  # only the centre is within 1 bit of each
        pairs = met.where("is_self").select(F.col("variant").alias("a"), F.explode(members).alias("b"))
    return (pairs.where("a <> b")
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).distinct())


def _roots(rows: DataFrame, distance: int) -> DataFrame:
    """(fp, root) for fingerprints that have a link."""
    return components(links(rows, distance)).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id
    (least doc_id that links lead to), component_size."""
    rows = materialize(fingerprints(docs, {"doc_id": docs["doc_id"]}, shingle), "simhash")
    per = rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    named = per.join(_roots(rows, distance), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = named.select("fp", "least", "n", "root")
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"),
                                       F.sum("n").alias("component_size"))
    labels = named.join(groups, "root").select("fp", "component_id", "component_size")
    return (rows.join(labels, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id", "component_size"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay, one a component (largest doc_id, as in
    exact dedup; null lowest), with all their columns. Rows whose fingerprint
    is alone leave at the first join; only the others are grouped."""
    rows = fingerprints(docs, {"doc": F.struct(*[docs[f"`{c}`"] for c in docs.columns])}, shingle)
    rows = materialize(rows, "simhash-rows")
    per = rows.select("fp").groupBy("fp").count()
    roots = _roots(rows.select("fp"), distance)
    crowded = materialize(per.join(roots, "fp", "left").where("root IS NOT NULL OR count > 1")
                          .select("fp", F.coalesce("root", "fp").alias("root")), "simhash-crowded")
    alone = rows.join(crowded, "fp", "left_anti").select("doc")
    best = F.max_by("doc", F.struct(F.col("doc.doc_id").alias("id"), F.xxhash64("doc").alias("tie")))
    one = rows.join(crowded, "fp").groupBy("root").agg(best.alias("doc")).select("doc")
    return alone.union(one).select("doc.*")
