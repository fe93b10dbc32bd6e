"""Catalogue entries: re-ranking in batch form, encoded lists, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratings_spark.functions.lists import decode_recs, encode_recs
from ratings_spark.operators import rerank, similarity
from ratings_spark.plans.catalogue import (
    FACTORS_SQL, MESSAGE_ORDER_SQL, MESSAGES_SQL, RATINGS_SQL, query, r6, with_)
from ratings_spark.session import materialize
from ratings_spark.sources import adapters as A

RERANK_SIM = 0.3   # used both for the similarity table and the score filter

_PARTS = dict(
    msg=MESSAGES_SQL, r=RATINGS_SQL, f=FACTORS_SQL,
    e=f"""
  SELECT a.id AS mid, b.id AS other_mid, list_cosine_similarity(a.features, b.features) AS sim
  FROM f a JOIN f b ON a.id <> b.id
  WHERE list_cosine_similarity(a.features, b.features) > {RERANK_SIM}""",
    o=f"""
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY {MESSAGE_ORDER_SQL}) AS rn FROM msg""",
    trig="SELECT uid, mid FROM o WHERE rn = 1",
    rec="SELECT uid, mid, score FROM o WHERE rn <= 20",
    cand0="""
  SELECT t.uid, e.other_mid AS mid, e.sim FROM trig t JOIN e ON e.mid = t.mid
  WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.uid = t.uid AND r.mid = e.other_mid)""",
    cand="""
  SELECT uid, mid, sim, row_number() OVER (PARTITION BY uid ORDER BY sim DESC, mid) AS rk
  FROM cand0""",
    x="""
  SELECT c.uid, c.mid AS cand, q.score AS rscore, e.sim
  FROM cand c JOIN rec q ON q.uid = c.uid JOIN e ON e.mid = c.mid AND e.other_mid = q.mid
  WHERE c.rk <= 20""",
    scores="""
  SELECT uid, cand AS mid,
         avg(sim * rscore) + log2(greatest(count(*) FILTER (WHERE rscore > 3), 1))
                           - log2(greatest(count(*) FILTER (WHERE rscore <= 3), 1)) AS score
  FROM x GROUP BY uid, cand""",
)

_CTES = with_(**_PARTS)
RERANK_ORACLE = _CTES + "SELECT uid, mid, round(score, 6) AS score FROM scores"

# Messages without ids: the log keeps one message of each user and second, and
# the incoming one is not among the ratings it is scored against.
RERANK_NOID_ORACLE = with_(**{
    **_PARTS,
    "msg": f"""
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY uid, timestamp ORDER BY msg_id DESC) AS one
    FROM ({MESSAGES_SQL})) WHERE one = 1""",
    "rec": "SELECT uid, mid, score FROM o WHERE rn BETWEEN 2 AND 21",
}) + "SELECT uid, mid, round(score, 6) AS score FROM scores"


# Items of the user's own messages count as rated too.
RERANK_RATED_ORACLE = with_(**{
    **_PARTS,
    "cand0": """
  SELECT t.uid, e.other_mid AS mid, e.sim FROM trig t JOIN e ON e.mid = t.mid
  WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.uid = t.uid AND r.mid = e.other_mid)
    AND NOT EXISTS (SELECT 1 FROM msg WHERE msg.uid = t.uid AND msg.mid = e.other_mid)""",
}) + "SELECT uid, mid, round(score, 6) AS score FROM scores"


def _inputs(spark: SparkSession, d: str):
    msgs = A.messages(spark, d)
    # The similarity table is what the offline job stores; written once here, for the
    # items that have a message: edges grow with the square of the items, and both
    # look-ups are by such an item.
    edges = similarity.item_similarity(A.factors(spark, d), RERANK_SIM)
    edges = materialize(edges.join(msgs.select("mid").distinct(), "mid", "left_semi"), "item_recs")
    rated = A.ratings(spark, d).select("uid", "mid")
    return msgs, edges, rated


def _rerank(msgs: DataFrame, edges: DataFrame, rated: DataFrame) -> DataFrame:
    return rerank.rerank(msgs, edges, rated, 20, 20, RERANK_SIM, score_edges=rerank.flipped(edges))


@query("unseen_neighbours", _CTES + """
SELECT uid, CAST(rk AS INTEGER) AS rank, mid, round(sim, 6) AS sim FROM cand WHERE rk <= 20""")
def q_unseen_neighbours(spark: SparkSession, d: str) -> DataFrame:
    msgs, edges, rated = _inputs(spark, d)
    c = rerank.unseen_neighbours(rerank.latest_messages(msgs), edges, rated, 20, RERANK_SIM)
    return c.select("uid", "rank", "mid", r6("sim").alias("sim"))


@query("rerank_scores", RERANK_ORACLE)
def q_rerank_scores(spark: SparkSession, d: str) -> DataFrame:
    msgs, edges, rated = _inputs(spark, d)
    s = _rerank(msgs, edges, rated)
    return s.select("uid", "mid", r6("score").alias("score"))


@query("recs_encoded", _CTES + """
SELECT uid, string_agg(CAST(mid AS VARCHAR) || ':' || printf('%.6f', score), '|'
                       ORDER BY score DESC, mid) AS recs_text,
       CAST(count(*) AS INTEGER) AS n_recs
FROM scores GROUP BY uid""")
def q_recs_encoded(spark: SparkSession, d: str) -> DataFrame:
    """Lists as text with six decimals, and the number of items that decoding
    the text in full gives back unchanged."""
    msgs, edges, rated = _inputs(spark, d)
    nested = rerank.nested_recs(_rerank(msgs, edges, rated))
    back = F.arrays_zip(F.col("recs").alias("a"), decode_recs(encode_recs("recs")).alias("b"))
    same = F.filter(back, lambda x: x["a"] == x["b"])
    return nested.select("uid", encode_recs("recs", 6).alias("recs_text"),
                         F.size(same).cast("int").alias("n_recs"))


@query("latest_recs", RERANK_ORACLE)
def q_latest_recs(spark: SparkSession, d: str) -> DataFrame:
    """Three time-ordered slices of the message log are re-ranked as three
    successive versions (recents as of each slice's end); the latest version
    per user must equal a single re-rank over the whole log. Every user in a
    slice gets a version row, possibly with an empty list, which replaces
    the older one (as the original replaced the user's document)."""
    msgs, edges, rated = _inputs(spark, d)
    # Slice boundaries from two approximate quantiles of the message id
    # (a distributed sketch; no single-partition window over the whole log).
    q1, q2 = msgs.approxQuantile("msg_id", [1 / 3, 2 / 3], 0.001)
    sliced = msgs.withColumn("slice", F.when(F.col("msg_id") <= q1, 1)
                             .when(F.col("msg_id") <= q2, 2).otherwise(3))
    versions = []
    for b in range(1, 4):
        upto = sliced.where(F.col("slice") <= b)
        in_batch = sliced.where(F.col("slice") == b)
        trig = rerank.latest_messages(in_batch)
        rec = rerank.recents_from_messages(upto, 20)
        cands = rerank.unseen_neighbours(trig, edges, rated, 20, RERANK_SIM)
        nested = rerank.nested_recs(rerank.rerank_scores(cands, rec, rerank.flipped(edges), RERANK_SIM))
        users = trig.select("uid").join(nested, "uid", "left") \
            .select("uid", F.coalesce("recs", F.array().cast("array<struct<mid:bigint,r:double>>"))
                    .alias("recs"), F.lit(b).alias("batch_id"))
        versions.append(users)
    allv = versions[0].unionByName(versions[1]).unionByName(versions[2])
    last = rerank.latest_version(allv, "uid", "batch_id")
    flat = last.select("uid", F.explode("recs").alias("x"))
    return flat.select("uid", F.col("x.mid").alias("mid"), r6("x.r").alias("score"))


@query("message_recents", with_(msg=MESSAGES_SQL) + f"""
, o AS (SELECT uid, mid, score,
               row_number() OVER (PARTITION BY uid ORDER BY {MESSAGE_ORDER_SQL}) AS rn FROM msg)
SELECT uid, CAST(rn AS INTEGER) AS rank, mid, score FROM o WHERE rn <= 20""")
def q_message_recents(spark: SparkSession, d: str) -> DataFrame:
    """Each user's 20 newest rated items in the message log (batch form of
    the streaming state)."""
    return rerank.recents_from_messages(A.messages(spark, d), 20)
