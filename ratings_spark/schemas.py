"""Declared schemas (no inference anywhere)."""

from pyspark.sql import types as T

# The columns of the input and output tables, in their order.
MOVIE_TEXT_COLUMNS = ["name", "descri", "timelong", "issue", "shoot",
                      "language", "genres", "actors", "directors"]

MOVIE = T.StructType(
    [T.StructField("mid", T.IntegerType(), False)]
    + [T.StructField(c, T.StringType(), True) for c in MOVIE_TEXT_COLUMNS]
)

RATING = T.StructType([
    T.StructField("uid", T.IntegerType(), False),
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
    T.StructField("timestamp", T.LongType(), False),  # epoch seconds
])

TAG = T.StructType([
    T.StructField("uid", T.IntegerType(), False),
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("tag", T.StringType(), True),
    T.StructField("timestamp", T.LongType(), False),
])
