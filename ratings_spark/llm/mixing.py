"""Mixing sources to target weights along a training curriculum.

Every source has a target amount of words (its weight's share of the whole,
bounded by a number of repeats, the excess shared out again) and a schedule: its
weight at equally spaced moments of training, linear in between. The integral
of the schedule, scaled to the target, is the source's cumulative demand. A
source's documents stand in a fixed shuffled order; the words before a document
in it are a cumulative supply, and the moment at which the demand reaches that
amount is the document's position in training. Documents are repeated epoch by
epoch while the demand lasts, and the whole mix is range-sorted by position.

Running sums are taken in two levels. Every source's rows are dealt into groups
of about ``GROUP_ROWS`` by their place in the hash order; sums run over groups
within a source and over rows within a group, so no task takes a whole source.
Only the per-source table (one row a source) is sorted in one task.

Defined results: null text has size 0; null source is a source of its own,
sorted last; a source without words has target 0 and none of its documents is
taken; a document of size 0 is taken as often as its place says and adds no
words. Rows that are equal in doc_id, text and source are interchangeable.
An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import let, text_of, words

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
# Schedules by the source's rank, as WEIGHTS: shape over training, from start to
# end; its mean does not matter, as it is scaled to the target.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
GROUP_ROWS = 512


def size_of(text: Column) -> Column:
    """Number of words."""
    return F.size(words(text)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS,
            schedules=SCHEDULES) -> DataFrame:
    """Adds ``sid`` (rank by code point, null last), ``target`` and ``knots``
    (the schedule) to (source, source_size, n).

    Targets are min(cap, level * weight) with one level for all that makes them
    add up to the whole: sources in order of cap / weight, each tried as the
    first one below its cap."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    table = sizes.withColumn("sid", F.row_number().over(by_name)).withColumns({
        "weight": F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") - 1) % len(weights) + 1),
        "knots": F.element_at(F.array(*[F.array(*map(F.lit, map(float, s))) for s in schedules]),
                              (F.col("sid") - 1) % len(schedules) + 1),
        "cap": (F.col("source_size") * max_repeats).cast("double"),
    })
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    since = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    table = table.withColumns({
        "whole": F.sum("source_size").over(everything),
        "level": (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(since),
    })
    # The level is right at the first source whose cap it does not reach.
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(
        fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (table.withColumn("the_level", level)
            .withColumn("target", F.least("cap", F.coalesce(F.col("the_level") * F.col("weight"), "cap")))
            .select("sid", "source", "source_size", "n", "weight", "knots", "target"))


def _moment(done: Column, knots: Column) -> Column:
    """The moment (0 to 1) at which the integral of the piecewise linear
    ``knots`` reaches the share ``done`` of its whole: the segment in which it
    falls, then the quadratic within it."""
    def solve(w):
        steps = F.size(w) - 1
        area = F.transform(F.sequence(F.lit(1), steps), lambda i: (F.get(w, i - 1) + F.get(w, i)) / 2)
        ends = F.transform(F.sequence(F.lit(1), steps),
                           lambda i: F.aggregate(F.slice(area, F.lit(1), i), F.lit(0.0), lambda a, x: a + x))
        whole = F.element_at(ends, -1)
        need = done * whole
        seg = F.least(F.size(F.filter(ends, lambda e: e <= need)), steps - 1)
        rest = need - F.when(seg > 0, F.get(ends, seg - 1)).otherwise(0.0)
        a, b = F.get(w, seg), F.get(w, seg + 1)
        root = F.sqrt(F.greatest(a * a + 2 * (b - a) * rest, F.lit(0.0)))
        # rest = a x + (b - a) x^2 / 2, in the form that also holds for a = b
        x = F.when(a + root > 0, 2 * rest / (a + root)).otherwise(0.0)
        return (seg + F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))) / steps
    return let(knots, solve)


def _rows(docs: DataFrame, row: Column | None = None) -> DataFrame:
    text = text_of(docs)
    source = docs["source"].cast("string")
    return docs.select(
        docs["doc_id"], source.alias("source"), size_of(text).alias("size"),
        # Uniform, and independent of the input's order.
        F.md5(F.concat_ws("\u0001", docs["doc_id"].cast("string"), source, text)).alias("key"),
        *([] if row is None else [row.alias("row")]))


def assign(docs: DataFrame, row: Column | None = None, weights=WEIGHTS,
           max_repeats: int = MAX_REPEATS, schedules=SCHEDULES) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken,
    ``copies`` (times it is taken), ``places`` (its positions in training) and,
    if given, ``row`` (a column of ``docs``, such as a struct of all). Sums are made from a written table without texts."""
    slim = materialize(_rows(docs), "mix-sizes")
    sources = materialize(
        targets(slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")),
                weights, max_repeats, schedules), "mix-sources")
    share = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)

    def dealt(rows):
        """With the source's numbers; the written table's size decides the join."""
        s = sources.withColumnRenamed("source", "s")
        return (rows.join(s, F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
                .withColumn("part", F.floor(share * F.ceil(F.col("n") / GROUP_ROWS))))

    ahead = (dealt(slim).groupBy("sid", "part").agg(F.sum("size").alias("words"))
             .withColumn("ahead", F.sum("words").over(
                 Window.partitionBy("sid").orderBy("part")
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words"))
             .select("sid", "part", "ahead"))
    inside = (Window.partitionBy("sid", "part").orderBy("key", "doc_id")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (dealt(slim if row is None else _rows(docs, row))
              .withColumn("inside", F.sum("size").over(inside) - F.col("size"))
              .join(ahead, ["sid", "part"])
              .withColumn("start", F.col("ahead") + F.col("inside")))
    # Copy e of a document stands e whole epochs after the first; it is taken
    # if its middle lies within the demand.
    middle = (F.col("target") - F.col("start") - F.col("size") / 2) / F.col("source_size")
    copies = F.when(F.col("source_size") > 0,
                    F.least(F.greatest(F.floor(middle) + 1, F.lit(0)), F.lit(max_repeats)))
    placed = placed.withColumn("copies", F.coalesce(copies, F.lit(0)).cast("int"))
    position = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda e: e < F.col("copies")),
        lambda e: _moment(F.least((F.col("start") + F.col("size") / 2 + e * F.col("source_size"))
                                  / F.col("target"), F.lit(1.0)), F.col("knots")))
    return placed.select("doc_id", "size", "source_size", "target",
                         (F.col("size") * F.col("copies")).alias("taken"), "copies",
                         position.alias("places"), *([] if row is None else ["row"]))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as
    often as it is taken, range-sorted by position in training."""
    doc = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    rows = assign(docs, doc, **settings).select(F.explode("places").alias("place"), "row")
    return (rows.repartitionByRange("place").sortWithinPartitions("place", F.col("row.doc_id"))
            .select("row.*"))


def taken(docs: DataFrame, **settings) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target,
    taken, copies, first_place (null if not taken), in training order."""
    rows = assign(docs, **settings)
    return (rows.withColumn("first_place", F.round(F.array_min("places"), 9)).drop("places")
            .repartitionByRange(F.col("first_place").asc_nulls_last(), "doc_id")
            .sortWithinPartitions(F.col("first_place").asc_nulls_last(), "doc_id"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5(concat_ws(chr(1), doc_id, source, t)) AS key,
    len(list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM (SELECT doc_id, source, coalesce(text, '') AS t FROM documents)),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k
  FROM d GROUP BY source),
w AS (
  SELECT *, ([5, 2, 1]::DOUBLE[])[k % 3 + 1] AS weight, 3.0::DOUBLE * source_size AS cap,
    ([[1.5, 1, 0.5], [1, 1, 1], [0.5, 1, 1.5]]::DOUBLE[][])[k % 3 + 1] AS knots FROM s),
l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (
      ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (
      ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (
  SELECT source, source_size, knots, least(cap, coalesce(weight * (
    SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1), cap)) AS target
  FROM l),
c AS (
  SELECT doc_id, size, source_size, target, knots, sum(size) OVER (
    PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(greatest(
      floor((target - start - size / 2.0::DOUBLE) / source_size) + 1, 0), 3) ELSE 0 END::INTEGER AS copies,
    (knots[1] + knots[2]) / 2 AS a1, (knots[1] + knots[2]) / 2 + (knots[2] + knots[3]) / 2 AS area,
    least((start + size / 2.0::DOUBLE) / target, 1) * area AS need, (need >= a1)::INTEGER AS seg,
    need - CASE WHEN seg = 1 THEN a1 ELSE 0 END AS rest, knots[seg + 1] AS a, knots[seg + 2] AS b,
    sqrt(greatest(a * a + 2 * (b - a) * rest, 0)) AS root
  FROM c)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies,
  CASE WHEN copies > 0 THEN round((seg + least(greatest(2 * rest / (a + root), 0), 1)) / 2, 9) END AS first_place
FROM n
"""
