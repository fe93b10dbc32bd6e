"""Rating statistics: counts, monthly counts, averages, per-genre top lists.

All aggregations here are algebraic (count, sum/count), so Spark combines
them map-side before the shuffle; a hot item costs one partial row per input
partition.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratings_spark.constants import DEFAULT_GENRES, GENRE_TOP_K
from ratings_spark.functions.dates import year_month
from ratings_spark.operators.topk import nest_ranked, top_k


def rating_counts(ratings: DataFrame, ordered: bool = True) -> DataFrame:
    """(mid, count): number of ratings per item, most rated first."""
    out = ratings.groupBy("mid").agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count"), "mid") if ordered else out


def monthly_counts(ratings: DataFrame, ordered: bool = True) -> DataFrame:
    """(mid, count, yearmonth): ratings per item and UTC calendar month
    (``yyyyMM`` as a number), newest month first, then most rated."""
    ym = ratings.select("mid", year_month("timestamp").alias("yearmonth"))
    out = ym.groupBy("yearmonth", "mid").agg(F.count(F.lit(1)).alias("count")) \
            .select("mid", "count", "yearmonth")
    return out.orderBy(F.desc("yearmonth"), F.desc("count"), "mid") if ordered else out


def average_scores(ratings: DataFrame) -> DataFrame:
    """(mid, avg): mean score per item."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def genre_frame(spark: SparkSession, genres: Sequence[str] | None = None) -> DataFrame:
    """The genre list as a one-column frame (a fixed, small literal list).
    A name given twice is kept once (it would otherwise double its matches).
    From an Arrow table it is a local relation, whose size the planner knows."""
    gl = list(dict.fromkeys(DEFAULT_GENRES if genres is None else genres))
    return spark.createDataFrame(pa.table({"genre": pa.array(gl, pa.string())}))


def genre_matches(movies_scored: DataFrame, genres: DataFrame,
                  match: str = "substring") -> DataFrame:
    """Pairs (genre, movie) where the movie's ``genres`` text names the genre.

    ``substring`` (default, as originally specified): case-insensitive
    substring, so ``War`` also matches ``Warfare``. A substring test has no
    join key, so each distinct text is tried against each name once (the
    planner broadcasts the list if its size allows), and the names found
    are joined back on the text.

    ``token``: exact, case-insensitive match of one ``|``-separated entry,
    an equi-join whose strategy Spark picks from the sizes.
    """
    g = genres.select(F.col("genre"), F.lower("genre").alias("_g"))
    if match == "substring":
        m = movies_scored.withColumn("_lg", F.lower("genres"))
        texts = m.select("_lg").distinct()
        found = texts.join(g, F.col("_lg").contains(F.col("_g"))).select("_lg", "genre")
        return m.join(found, "_lg").drop("_lg")
    if match == "token":
        m = movies_scored.withColumn("_g", F.explode(F.array_distinct(
            F.split(F.lower("genres"), "\\|"))))
        m = m.withColumn("_g", F.trim("_g"))
        return m.join(g, "_g").drop("_g")
    raise ValueError(f"unknown match mode {match!r}")


def genre_top(movies: DataFrame, ratings: DataFrame, genres: DataFrame,
              k: int = GENRE_TOP_K, match: str = "substring",
              averages: DataFrame | None = None) -> DataFrame:
    """Flat per-genre top list: (genre, rank, mid, avg).

    Movies without ratings drop out (inner join with the averages). Ranking is
    by average descending, ties by mid ascending.
    """
    avg = averages if averages is not None else average_scores(ratings)
    scored = movies.select("mid", "genres").join(avg, "mid")
    pairs = genre_matches(scored, genres, match).select("genre", "mid", "avg")
    return top_k(pairs, ["genre"], [F.desc("avg"), F.asc("mid")], k) \
        .select("genre", "rank", "mid", "avg")


def genre_top_nested(flat: DataFrame) -> DataFrame:
    """(genres, recs array<struct<mid, r>>) from ``genre_top`` output."""
    return nest_ranked(flat, ["genre"], "rank", {"mid": "mid", "r": "avg"}) \
        .withColumnRenamed("genre", "genres")
