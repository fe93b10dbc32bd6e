"""Statistics: counts, months in UTC, averages, genre matching and ties, tag documents."""

from conftest import rows
from pyspark.sql import functions as F

from ratings_spark.functions.dates import year_month
from ratings_spark.operators import catalog, stats


def ratings_df(spark, data):
    return spark.createDataFrame(data, "uid long, mid long, score double, timestamp long")


def test_counts_and_order(spark):
    r = ratings_df(spark, [(1, 10, 3.0, 0), (2, 10, 4.0, 0), (1, 11, 5.0, 0), (3, 12, 1.0, 0),
                           (4, 12, 2.0, 0)])
    out = [tuple(x) for x in stats.rating_counts(r).collect()]
    assert out == [(10, 2), (12, 2), (11, 1)]   # count desc, ties by mid


def test_month_boundary_utc(spark):
    # 1995-01-31 23:59:59 UTC and 1995-02-01 00:00:00 UTC
    r = ratings_df(spark, [(1, 1, 1.0, 791596799), (1, 1, 1.0, 791596800), (2, 1, 1.0, 791596800)])
    assert rows(stats.monthly_counts(r)) == [(1, 1, 199501), (1, 2, 199502)]
    one = spark.createDataFrame([(0,)], "t long").select(year_month("t").alias("ym")).first()
    assert one["ym"] == 197001


def test_average(spark):
    r = ratings_df(spark, [(1, 1, 1.0, 0), (2, 1, 2.0, 0), (1, 2, 5.0, 0)])
    assert rows(stats.average_scores(r)) == [(1, 1.5), (2, 5.0)]


def movies_df(spark, data):
    return spark.createDataFrame(data, "mid long, genres string")


def test_genre_substring_vs_token(spark):
    m = movies_df(spark, [(1, "War|Drama"), (2, "Warfare"), (3, "Comedy"), (4, "war ")])
    r = ratings_df(spark, [(1, 1, 4.0, 0), (1, 2, 5.0, 0), (1, 3, 3.0, 0), (1, 4, 2.0, 0)])
    g = stats.genre_frame(spark, ["War", "Ccrime"])
    sub = rows(stats.genre_top(m, r, g, 10, "substring"), "genre", "rank", "mid")
    assert sub == [("War", 1, 2), ("War", 2, 1), ("War", 3, 4)]   # Warfare matches
    tok = rows(stats.genre_top(m, r, g, 10, "token"), "genre", "rank", "mid")
    assert tok == [("War", 1, 1), ("War", 2, 4)]


def test_genre_topk_ties_and_unrated(spark):
    m = movies_df(spark, [(i, "Drama") for i in range(1, 14)])
    # movie 13 has no rating -> drops out; 12 movies all with avg 3.0 -> ids 1..10
    r = ratings_df(spark, [(1, i, 3.0, 0) for i in range(1, 13)])
    out = stats.genre_top(m, r, stats.genre_frame(spark, ["drama"]), 10)
    assert rows(out, "rank", "mid") == [(i, i) for i in range(1, 11)]
    nested = stats.genre_top_nested(out).first()
    assert nested["genres"] == "drama" and [x["mid"] for x in nested["recs"]] == list(range(1, 11))


def test_tags_and_search_document(spark):
    t = spark.createDataFrame([(1, 1, "b", 0), (2, 1, "a", 0), (3, 1, "b", 0), (1, 5, "z", 0)],
                              "uid long, mid long, tag string, timestamp long")
    tb = {r["mid"]: (r["tags"], r["tags_text"], r["n_tags"]) for r in
          catalog.tags_by_movie(t).collect()}
    assert tb == {1: (["a", "b"], "a|b", 2), 5: (["z"], "z", 1)}
    movies = spark.createDataFrame(
        [(1, "A", "", "", "", "", "en", "Drama", "", ""), (2, "B", "", "", "", "", "en", "War", "", "")],
        "mid long, name string, descri string, timelong string, issue string, shoot string, "
        "language string, genres string, actors string, directors string")
    doc = {r["mid"]: r["tags_text"] for r in catalog.movie_with_tags(movies, t).collect()}
    assert doc == {1: "a|b", 2: None}   # untagged kept; tag of unknown movie 5 dropped


def test_results_do_not_depend_on_session_time_zone(spark):
    from conftest import SF_SMALL
    from ratings_spark.sources import adapters as A
    base = rows(stats.monthly_counts(A.ratings(spark, SF_SMALL), ordered=False))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert rows(stats.monthly_counts(A.ratings(spark, SF_SMALL), ordered=False)) == base
        ts = rows(A.messages(spark, SF_SMALL).select("timestamp"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ts == rows(A.messages(spark, SF_SMALL).select("timestamp"))


def test_epoch_seconds_both_kinds(spark):
    from ratings_spark.functions.dates import epoch_seconds
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        r = spark.sql("SELECT TIMESTAMP_NTZ'1970-01-02 00:00:00' AS n, "
                      "TIMESTAMP'1970-01-02 09:00:00' AS l").select(
            epoch_seconds("n").alias("n"), epoch_seconds("l", "ltz").alias("l")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["n"] == 86400 and r["l"] == 86400   # 09:00 in Tokyo is 00:00 UTC


def test_wall_clock_times_that_a_zone_skips(spark):
    """02:30 on the day clocks go forward does not exist in Los Angeles."""
    from ratings_spark.functions.dates import epoch_seconds
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' AS t UNION ALL "
                   "SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59' UNION ALL SELECT NULL")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = {r[0] for r in df.select(epoch_seconds("t")).collect()}
            assert got == {1710037800, -1, None}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_any_number_of_genre_names(spark):
    movies = spark.createDataFrame([(1, "War|Drama"), (2, "Warfare"), (3, "war|drama"), (4, None)],
                                   "mid long, genres string").withColumn("avg", F.lit(1.0))
    names = ["War", "Drama"] + [f"name{k}" for k in range(12_000)]
    got = stats.genre_matches(movies, stats.genre_frame(spark, names))
    assert rows(got, "genre", "mid") == [("Drama", 1), ("Drama", 3), ("War", 1), ("War", 2), ("War", 3)]
