"""Item catalogue documents: tag sets and the search document."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratings_spark.schemas import MOVIE_TEXT_COLUMNS


def tags_by_movie(tags: DataFrame) -> DataFrame:
    """(mid, tags array<string> sorted distinct, tags_text 'a|b|c', n_tags).

    ``collect_set`` is merged map-side first, so a hot item contributes one
    partial set per input partition; the output value itself is the item's
    distinct tag set.
    """
    agg = tags.where(F.col("tag").isNotNull()).groupBy("mid").agg(
        F.array_sort(F.collect_set("tag")).alias("tags"))
    return agg.select("mid", "tags", F.array_join("tags", "|").alias("tags_text"),
                      F.size("tags").alias("n_tags"))


def movie_with_tags(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Search document: every movie with its tag set (NULL when untagged)."""
    t = tags_by_movie(tags).select("mid", "tags", "tags_text")
    return movies.select("mid", *MOVIE_TEXT_COLUMNS).join(t, "mid", "left")
