"""Adapters from the driver's TPC-H-like tables to this library's inputs.

They give every query real, scale-growing input: ratings from line items
joined to their orders, a movie catalogue from parts, rating messages from
the event log and factor vectors from the embeddings table.

| output   | built from              | mapping                                              |
|----------|-------------------------|------------------------------------------------------|
| ratings  | lineitem ⋈ orders       | uid=o_custkey, mid=l_partkey, score=ceil(qty/5)/2    |
| tags     | lineitem ⋈ orders       | as ratings, tag=o_orderpriority                      |
| movies   | part                    | mid=p_partkey, genres='type|name words', ...         |
| messages | events                  | uid=user_id, mid=props.k, score=min(10,1+v/10)/2     |
| factors  | embeddings              | id=vec_id, features=embedding                        |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratings_spark.functions.dates import epoch_seconds
from ratings_spark.schemas import MOVIE_TEXT_COLUMNS

# Columns that, after the timestamp, make the recency order of ratings total
# (order dates have day resolution and (orderkey, linenumber) repeats).
RATING_TIEBREAK = ["l_orderkey", "l_linenumber", "mid", "l_suppkey", "l_quantity",
                   "l_extendedprice"]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _rated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, mid, score, timestamp) plus the line-item tie-break columns."""
    j = _rated_lines(spark, sf_dir)
    return j.select(
        F.col("o_custkey").alias("uid"),
        F.col("l_partkey").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("score"),
        epoch_seconds("o_orderdate").alias("timestamp"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _rated_lines(spark, sf_dir)
    return j.select(
        F.col("o_custkey").alias("uid"),
        F.col("l_partkey").alias("mid"),
        F.col("o_orderpriority").alias("tag"),
        epoch_seconds("o_orderdate").alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _t(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("mid"),
        F.col("p_name").alias("name"),
        F.lit("").alias("descri"),
        F.concat(F.col("p_size").cast("string"), F.lit(" minutes")).alias("timelong"),
        F.lit("").alias("issue"),
        (F.col("p_size") + 1970).cast("string").alias("shoot"),
        F.col("p_brand").alias("language"),
        F.concat_ws("|", F.col("p_type"), F.replace(F.col("p_name"), F.lit(" "), F.lit("|")))
         .alias("genres"),
        F.col("p_brand").alias("actors"),
        F.lit("").alias("directors"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, mid, score, timestamp, msg_id) rating messages from the event log."""
    e = _t(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("uid"),
        F.get_json_object("props", "$.k").cast("long").alias("mid"),
        (F.least(F.lit(10), 1 + F.floor(F.col("value") / 10)) / 2).cast("double").alias("score"),
        epoch_seconds("ts").alias("timestamp"),
        F.col("event_id").alias("msg_id"),
    )


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, features) vectors, in the shape of an ALS factor table."""
    return _t(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features"))


# --- text renderings of the adapters (inputs for the line parsers) ----------

def movie_lines(m: DataFrame) -> DataFrame:
    """``^``-joined movie lines, each field padded with a space to exercise
    trimming."""
    cols = ["mid", *MOVIE_TEXT_COLUMNS]
    return m.select(F.concat_ws("^", *[F.concat(F.lit(" "), F.col(c).cast("string"), F.lit(" "))
                                       for c in cols]).alias("value"))


def rating_lines(r: DataFrame) -> DataFrame:
    return r.select(F.concat_ws(",", *[F.col(c).cast("string") for c in
                                       ["uid", "mid", "score", "timestamp"]]).alias("value"))


def tag_lines(t: DataFrame) -> DataFrame:
    return t.select(F.concat_ws(",", F.col("uid").cast("string"), F.col("mid").cast("string"),
                                F.col("tag"), F.col("timestamp").cast("string")).alias("value"))


def message_lines(msg: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return msg.select(F.concat_ws("|", *[F.col(c).cast("string") for c in
                                         ["uid", "mid", "score", "timestamp", "msg_id"]])
                      .alias("value"), *(keep or []))
