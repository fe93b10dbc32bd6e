"""Property tests against pure-Python brute force on random small inputs."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ratings_spark.operators import stats
from ratings_spark.operators.topk import top_k

groups = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50), st.integers(0, 4)),
                  min_size=0, max_size=60, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=8, deadline=None)
@given(groups, st.integers(1, 5))
def test_top_k_matches_sort(spark, data, k):
    df = spark.createDataFrame(data, "g int, id int, v int")
    got = sorted((r["g"], r["rank"], r["id"]) for r in
                 top_k(df, ["g"], [F.desc("v"), F.asc("id")], k).collect())
    want = []
    for g in {t[0] for t in data}:
        items = sorted((t for t in data if t[0] == g), key=lambda t: (-t[2], t[1]))[:k]
        want += [(g, i + 1, t[1]) for i, t in enumerate(items)]
    assert got == sorted(want)


words = st.sampled_from(["War", "warfare", "Drama", "dram", "Comedy", "x|y", "WAR"])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.lists(words, min_size=1, max_size=3), st.integers(1, 10)),
                min_size=1, max_size=15),
       st.lists(st.sampled_from(["war", "Drama", "y", "Ccrime"]), min_size=1, max_size=3,
                unique=True))
def test_genre_substring_matches_brute_force(spark, movies, genres):
    m = spark.createDataFrame([(i, "|".join(ws)) for i, (ws, _) in enumerate(movies)],
                              "mid long, genres string")
    r = spark.createDataFrame([(1, i, float(s), 0) for i, (_, s) in enumerate(movies)],
                              "uid long, mid long, score double, timestamp long")
    got = sorted((x["genre"], x["rank"], x["mid"]) for x in
                 stats.genre_top(m, r, stats.genre_frame(spark, genres), 3).collect())
    want = []
    for g in genres:
        hit = sorted(((-float(s), i) for i, (ws, s) in enumerate(movies)
                      if g.lower() in "|".join(ws).lower()))[:3]
        want += [(g, j + 1, i) for j, (_, i) in enumerate(hit)]
    assert got == sorted(want)
