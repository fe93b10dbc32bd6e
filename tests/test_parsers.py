"""Text parsers: trimming, typing, quarantine reasons, commas and quotes in tags."""

from conftest import rows

from ratings_spark.sources import text


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_movies_trim_types_and_quarantine(spark):
    good, bad = text.parse_movies(lines(
        spark,
        " 1 ^Toy Story (1995) ^ ^81 minutes^March 20, 2001^1995^English ^Adventure|Animation ^Tom Hanks|Tim Allen^John Lasseter",
        "2^Jumanji^^^^^^^^",                       # empty trailing fields: kept
        "3^too^few",                                # too few fields
        "x^name^a^b^c^d^e^f^g^h",                   # bad id
        "4^a^b^c^d^e^f^g^h^i^extra",                # extra field ignored
    ))
    g = {r["mid"]: r for r in good.collect()}
    assert set(g) == {1, 2, 4}
    assert g[1]["name"] == "Toy Story (1995)" and g[1]["language"] == "English"
    assert g[1]["genres"] == "Adventure|Animation"
    assert g[2]["directors"] == "" and g[2]["name"] == "Jumanji"
    assert g[4]["directors"] == "i"
    assert rows(bad, "reason") == [("fewer than 10 fields",), ("mid is not an integer",)]


def test_ratings(spark):
    good, bad = text.parse_ratings(lines(
        spark, "1,31,2.5,1260759144", " 2 , 5 , 4.0 , 99 ", "1,2,abc,3", "1,2,3", "9,9,1.0,99999999999"))
    assert rows(good) == [(1, 31, 2.5, 1260759144), (2, 5, 4.0, 99), (9, 9, 1.0, 99999999999)]
    assert rows(bad, "reason") == [("fewer than 4 fields",), ("score is not a finite number",)]


def test_tags_with_commas_and_quotes(spark):
    good, bad = text.parse_tags(lines(
        spark,
        "15,339,sandra 'boring' bullock,1138537770",
        '15,340,"funny, but long",1138537771',
        "15,341,a,b,c,1138537772",
        '15,342,"say ""hi""",1138537773',
        "15,343,1138537774",
        " 16 , 1 , dark , 5 ",
    ))
    t = {r["mid"]: r["tag"] for r in good.collect()}
    assert t == {339: "sandra 'boring' bullock", 340: "funny, but long", 341: "a,b,c",
                 342: 'say "hi"', 1: "dark"}
    assert [r["reason"] for r in bad.collect()] == ["fewer than 4 fields"]


def test_messages(spark):
    good, bad = text.parse_messages(lines(
        spark, "1|20|5.0|1564412038", "1|12|5.0|1564412037|7", "x|1|1|1", "1|2|3"))
    assert rows(good) == [(1, 12, 5.0, 1564412037, 7), (1, 20, 5.0, 1564412038, None)]
    assert len(bad.collect()) == 2


def test_csv_reader_variant(spark):
    from ratings_spark.schemas import RATING, TAG
    from ratings_spark.session import shared_dir
    base = shared_dir(spark, "test-csv-read")
    spark.createDataFrame(["1,31,2.5,1260759144", " 2 , 5 , 4.0 , 99 ", "1,2,abc,3"], "string") \
        .coalesce(1).write.text(f"{base}/r")
    good, bad = text.read_csv_table(spark, f"{base}/r", RATING)
    assert rows(good) == [(1, 31, 2.5, 1260759144), (2, 5, 4.0, 99)]
    assert [r["value"] for r in bad.collect()] == ["1,2,abc,3"]
    spark.createDataFrame(['15,340,"funny, but long",1138537771', '15,342,"say ""hi""",5'],
                          "string").coalesce(1).write.text(f"{base}/t")
    good, bad = text.read_csv_table(spark, f"{base}/t", TAG)
    assert {r["mid"]: r["tag"] for r in good.collect()} == {340: "funny, but long",
                                                            342: 'say "hi"'}
    assert bad.count() == 0
