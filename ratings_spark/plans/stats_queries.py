"""Catalogue entries: ingestion, statistics and catalogue documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratings_spark.operators import catalog, history, maintained, stats
from ratings_spark.plans.catalogue import (
    FIXTURE_GENRES, MESSAGES_SQL, MOVIES_SQL, RATING_ORDER_SQL, RATINGS_SQL, TAGS_SQL,
    query, r6, with_)
from ratings_spark.session import shared_dir
from ratings_spark.sources import adapters as A
from ratings_spark.sources import tables, text


# --- parsing -------------------------------------------------------------------

@query("parse_movies", with_(m=MOVIES_SQL) + """
SELECT CAST(mid AS INTEGER) AS mid, name, descri, timelong, issue, shoot, language,
       genres, actors, directors FROM m""")
def q_parse_movies(spark: SparkSession, d: str) -> DataFrame:
    good, _bad = text.parse_movies(A.movie_lines(A.movies(spark, d)))
    return good


@query("parse_ratings", with_(r=RATINGS_SQL) + """
SELECT CAST(uid AS INTEGER) AS uid, CAST(mid AS INTEGER) AS mid, score, timestamp FROM r""")
def q_parse_ratings(spark: SparkSession, d: str) -> DataFrame:
    good, _bad = text.parse_ratings(A.rating_lines(A.ratings(spark, d)))
    return good


@query("parse_ratings_csv", with_(r=RATINGS_SQL) + """
SELECT CAST(uid AS INTEGER) AS uid, CAST(mid AS INTEGER) AS mid, score, timestamp FROM r""")
def q_parse_ratings_csv(spark: SparkSession, d: str) -> DataFrame:
    """The same lines through the CSV parser (``from_csv``, PERMISSIVE)."""
    from ratings_spark.schemas import RATING
    good, _bad = text.parse_csv(A.rating_lines(A.ratings(spark, d)), RATING)
    return good


@query("parse_tags", with_(t=TAGS_SQL) + """
SELECT CAST(uid AS INTEGER) AS uid, CAST(mid AS INTEGER) AS mid, tag, timestamp FROM t""")
def q_parse_tags(spark: SparkSession, d: str) -> DataFrame:
    good, _bad = text.parse_tags(A.tag_lines(A.tags(spark, d)))
    return good


@query("parse_messages", with_(m=MESSAGES_SQL) + """
SELECT uid, mid, score, timestamp, msg_id FROM m""")
def q_parse_messages(spark: SparkSession, d: str) -> DataFrame:
    good, _bad = text.parse_messages(A.message_lines(A.messages(spark, d)))
    return good


# --- sinks ---------------------------------------------------------------------

@query("table_roundtrip", with_(r=RATINGS_SQL) + "SELECT uid, mid, score, timestamp FROM r")
def q_table_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "roundtrip")
    r = A.ratings(spark, d).select("uid", "mid", "score", "timestamp")
    tables.write_table(r, path, "parquet", mode="overwrite")
    return tables.read_table(spark, path, "parquet")


# --- statistics ----------------------------------------------------------------

@query("rating_counts", with_(r=RATINGS_SQL) + """
SELECT mid, count(*) AS count FROM r GROUP BY mid""")
def q_rating_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.rating_counts(A.ratings(spark, d))


@query("monthly_counts", with_(r=RATINGS_SQL) + """
SELECT mid, count(*) AS count,
       CAST(strftime(DATE '1970-01-01' + CAST(floor(timestamp / 86400) AS INTEGER), '%Y%m')
            AS BIGINT) AS yearmonth
FROM r GROUP BY ALL""")
def q_monthly_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.monthly_counts(A.ratings(spark, d))


@query("average_scores", with_(r=RATINGS_SQL) + """
SELECT mid, round(avg(score), 6) AS avg FROM r GROUP BY mid""")
def q_average_scores(spark: SparkSession, d: str) -> DataFrame:
    return stats.average_scores(A.ratings(spark, d)).select("mid", r6("avg").alias("avg"))


_GENRE_VALUES = ", ".join(f"('{g}')" for g in FIXTURE_GENRES)


@query("genre_top10", with_(r=RATINGS_SQL, m=MOVIES_SQL) + f"""
, a AS (SELECT mid, avg(score) AS avg FROM r GROUP BY mid)
, g(genre) AS (VALUES {_GENRE_VALUES})
, j AS (
  SELECT g.genre, m.mid, a.avg,
         row_number() OVER (PARTITION BY g.genre ORDER BY a.avg DESC, m.mid) AS rn
  FROM m JOIN a ON m.mid = a.mid
  JOIN g ON contains(lower(m.genres), lower(g.genre)))
SELECT genre, CAST(rn AS INTEGER) AS rank, mid, round(avg, 6) AS avg FROM j WHERE rn <= 10""")
def q_genre_top10(spark: SparkSession, d: str) -> DataFrame:
    out = stats.genre_top(A.movies(spark, d), A.ratings(spark, d),
                          stats.genre_frame(spark, FIXTURE_GENRES), k=10)
    return out.select("genre", "rank", "mid", r6("avg").alias("avg"))


@query("genre_top10_token", with_(r=RATINGS_SQL, m=MOVIES_SQL) + f"""
, a AS (SELECT mid, avg(score) AS avg FROM r GROUP BY mid)
, g(genre) AS (VALUES {_GENRE_VALUES})
, mt AS (SELECT DISTINCT mid, trim(unnest(string_split(lower(genres), '|'))) AS tok FROM m)
, j AS (
  SELECT g.genre, mt.mid, a.avg,
         row_number() OVER (PARTITION BY g.genre ORDER BY a.avg DESC, mt.mid) AS rn
  FROM mt JOIN a ON mt.mid = a.mid JOIN g ON mt.tok = lower(g.genre))
SELECT genre, CAST(rn AS INTEGER) AS rank, mid, round(avg, 6) AS avg FROM j WHERE rn <= 10""")
def q_genre_top10_token(spark: SparkSession, d: str) -> DataFrame:
    out = stats.genre_top(A.movies(spark, d), A.ratings(spark, d),
                          stats.genre_frame(spark, FIXTURE_GENRES), k=10, match="token")
    return out.select("genre", "rank", "mid", r6("avg").alias("avg"))


@query("maintained_statistics", with_(r=RATINGS_SQL) + """
, a AS (SELECT mid, count(*) AS item_count, round(avg(score), 6) AS avg FROM r GROUP BY mid)
, m AS (SELECT mid, count(*) AS count,
               CAST(strftime(DATE '1970-01-01' + CAST(floor(timestamp / 86400) AS INTEGER), '%Y%m')
                    AS BIGINT) AS yearmonth FROM r GROUP BY ALL)
SELECT m.mid, m.yearmonth, m.count, a.item_count, a.avg FROM m JOIN a ON m.mid = a.mid""")
def q_maintained_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Counts and averages from stored batches: out of order, one of them twice
    (once after it was folded into a snapshot)."""
    path = shared_dir(spark, "maintained")
    r = A.ratings(spark, d).withColumn("batch", F.pmod(F.xxhash64("uid", "mid", "timestamp"), F.lit(4)))
    for b in (2, 0, 3, 2, 1):
        maintained.write_batch(r.where(F.col("batch") == b), path, b)
        if b == 3:
            maintained.fold(spark, path)
    state = maintained.current(spark, path)
    items = maintained.rating_counts(state).withColumnRenamed("count", "item_count") \
        .join(maintained.average_scores(state).select("mid", r6("avg").alias("avg")), "mid")
    return maintained.monthly_counts(state).join(items, "mid").select("mid", "yearmonth", "count", "item_count", "avg")


# --- catalogue documents -------------------------------------------------------

@query("tags_by_movie", with_(t=TAGS_SQL) + """
SELECT mid, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags_text,
       CAST(count(DISTINCT tag) AS INTEGER) AS n_tags
FROM t WHERE tag IS NOT NULL GROUP BY mid""")
def q_tags_by_movie(spark: SparkSession, d: str) -> DataFrame:
    return catalog.tags_by_movie(A.tags(spark, d)).select("mid", "tags_text", "n_tags")


@query("movie_with_tags", with_(t=TAGS_SQL, m=MOVIES_SQL) + """
, tm AS (SELECT mid, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags_text,
                CAST(count(DISTINCT tag) AS INTEGER) AS n_tags
         FROM t WHERE tag IS NOT NULL GROUP BY mid)
SELECT m.mid, m.name, m.language, m.genres, tm.tags_text, tm.n_tags
FROM m LEFT JOIN tm ON m.mid = tm.mid""")
def q_movie_with_tags(spark: SparkSession, d: str) -> DataFrame:
    doc = catalog.movie_with_tags(A.movies(spark, d), A.tags(spark, d))
    return doc.select("mid", "name", "language", "genres", "tags_text",
                      F.size("tags").cast("int").alias("n_tags")) \
        .withColumn("n_tags", F.when(F.col("tags_text").isNotNull(), F.col("n_tags")))


# --- history -------------------------------------------------------------------

@query("distinct_users", with_(r=RATINGS_SQL) + "SELECT DISTINCT uid FROM r")
def q_distinct_users(spark: SparkSession, d: str) -> DataFrame:
    return history.distinct_users(A.ratings(spark, d))


@query("recent_ratings", with_(r=RATINGS_SQL) + f"""
, x AS (SELECT uid, mid, score,
               row_number() OVER (PARTITION BY uid ORDER BY {RATING_ORDER_SQL}) AS rn FROM r)
SELECT uid, CAST(rn AS INTEGER) AS rank, mid, score FROM x WHERE rn <= 20""")
def q_recent_ratings(spark: SparkSession, d: str) -> DataFrame:
    return history.recent_ratings(A.ratings(spark, d), 20, tiebreak=A.RATING_TIEBREAK)


@query("genre_top10_nested", with_(r=RATINGS_SQL, m=MOVIES_SQL) + f"""
, a AS (SELECT mid, avg(score) AS avg FROM r GROUP BY mid)
, g(genre) AS (VALUES {_GENRE_VALUES})
, j AS (
  SELECT g.genre, m.mid, a.avg,
         row_number() OVER (PARTITION BY g.genre ORDER BY a.avg DESC, m.mid) AS rn
  FROM m JOIN a ON m.mid = a.mid
  JOIN g ON contains(lower(m.genres), lower(g.genre)))
SELECT genre AS genres, CAST(rn AS INTEGER) AS rank, mid, round(avg, 6) AS r FROM j WHERE rn <= 10""")
def q_genre_top10_nested(spark: SparkSession, d: str) -> DataFrame:
    """The nested per-genre table as the statistics job writes it, read back
    flat with each element's list position."""
    from ratings_spark.operators.topk import flatten_ranked
    flat = stats.genre_top(A.movies(spark, d), A.ratings(spark, d),
                           stats.genre_frame(spark, FIXTURE_GENRES), k=10)
    nested = stats.genre_top_nested(flat)
    return flatten_ranked(nested, ["genres"], "recs").select(
        "genres", "rank", "mid", r6("r").alias("r"))


@query("search_docs_roundtrip", with_(t=TAGS_SQL, m=MOVIES_SQL) + """
, tm AS (SELECT mid, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags_text
         FROM t WHERE tag IS NOT NULL GROUP BY mid)
SELECT m.mid, m.name, coalesce(tm.tags_text, '') AS tags_text
FROM m LEFT JOIN tm ON m.mid = tm.mid""")
def q_search_docs_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Search documents written keyed by ``mid`` (one document per id) and
    read back."""
    path = shared_dir(spark, "search_docs")
    doc = catalog.movie_with_tags(A.movies(spark, d), A.tags(spark, d)) \
        .withColumn("tags_text", F.coalesce("tags_text", F.lit("")))
    tables.write_table(doc, path, "parquet", unique_key="mid")
    return tables.read_table(spark, path).select("mid", "name", "tags_text")
