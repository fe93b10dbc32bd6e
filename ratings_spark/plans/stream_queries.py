"""Catalogue entries that run the streaming job.

The message log (from ``events``) arrives as three time-ordered slices of
text files; after each slice the query is (re)started from its checkpoint
with an ``availableNow`` trigger. The final per-user state must equal the
batch answers over the whole log, so the SQL oracles are the batch ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratings_spark.operators import history, rerank, similarity
from ratings_spark.operators.topk import latest
from ratings_spark.plans.catalogue import MESSAGE_ORDER_SQL, MESSAGES_SQL, RATINGS_SQL, query, r6, with_
from ratings_spark.plans.realtime_queries import (
    RERANK_NOID_ORACLE, RERANK_ORACLE, RERANK_RATED_ORACLE, RERANK_SIM)
from ratings_spark.session import release_unused, shared_dir
from ratings_spark.sources import adapters as A
from ratings_spark.streaming import rerank_stream as RS

# Items whose edges share a bucket of the similarity table.
BUCKET_ITEMS = 2048


def run_stream(spark: SparkSession, d: str, slices: int = 3, ids: bool = True,
               include_incoming: bool = True, rated_in_state: bool = False) -> str:
    """Feed the log in ``slices`` arrivals through the job; return its output
    folder. Without ``ids`` messages have four fields, and the log keeps one
    message of each user and second (the one of the largest id). With
    ``rated_in_state`` the rating history is given to the first start alone."""
    base = shared_dir(spark, "stream")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/checkpoint"
    # What the offline and load jobs leave behind: the similarity table and
    # the rated set, each stored partitioned by a hash bucket of its key.
    sim_path, rated_path = f"{base}/item_recs", f"{base}/rated"
    # Edges grow with the square of the items, so they are written once, in buckets by
    # the number of items: counting the edges would need another copy of them.
    vectors = A.factors(spark, d)
    history.write_by_bucket(similarity.item_similarity(vectors, RERANK_SIM), sim_path, "mid",
                            max(history.MIN_BUCKETS, -(-vectors.count() // BUCKET_ITEMS)))
    release_unused(spark)
    if not rated_in_state:
        history.write_by_bucket(history.distinct_pairs(A.ratings(spark, d)), rated_path, "uid",
                                history.MIN_BUCKETS)
        release_unused(spark)
    msgs = A.messages(spark, d)
    if not ids:
        msgs = latest(msgs, ["uid", "timestamp"], [F.desc("msg_id")])
    cuts = msgs.approxQuantile("msg_id", [i / slices for i in range(1, slices)], 0.001)
    lines = A.message_lines(msgs, keep=["msg_id"])
    if not ids:
        lines = lines.withColumn("value", F.substring_index("value", "|", 4))
    lo = None
    for i in range(slices):
        hi = cuts[i] if i < len(cuts) else None
        part = lines
        if lo is not None:
            part = part.where(F.col("msg_id") > lo)
        if hi is not None:
            part = part.where(F.col("msg_id") <= hi)
        part.select("value").write.mode("append").text(src)
        stream = RS.message_stream(spark, "text", src)
        if rated_in_state:
            rated = RS.RatedInState(A.ratings(spark, d) if i == 0 else None)
        else:
            rated = history.BucketedTable(spark, rated_path, "uid")
        q = RS.start(stream, out, ckpt,
                     sim_edges=history.BucketedTable(spark, sim_path, "mid"),
                     rated=rated, trigger={"availableNow": True}, threshold=RERANK_SIM,
                     include_incoming=include_incoming,
                     state_partitions=2 * spark.sparkContext.defaultParallelism)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream failed: {q.exception()}")
        release_unused(spark)
        lo = hi
    return out


def checkpoint_of(out: str) -> str:
    """The checkpoint of the job whose output folder ``run_stream`` returned."""
    return out.removesuffix("/out") + "/checkpoint"


def _flat(recs: DataFrame) -> DataFrame:
    flat = recs.select("uid", F.explode("recs").alias("x"))
    return flat.select("uid", F.col("x.mid").alias("mid"), r6("x.r").alias("score"))


@query("stream_rerank", RERANK_ORACLE)
def q_stream_rerank(spark: SparkSession, d: str) -> DataFrame:
    return _flat(RS.latest_recs(spark, run_stream(spark, d)))


@query("stream_rerank_noid", RERANK_NOID_ORACLE)
def q_stream_rerank_noid(spark: SparkSession, d: str) -> DataFrame:
    """Four-field messages, scored against the ratings before the incoming one."""
    return _flat(RS.latest_recs(spark, run_stream(spark, d, ids=False, include_incoming=False)))


@query("stream_rerank_rated", RERANK_RATED_ORACLE)
def q_stream_rerank_rated(spark: SparkSession, d: str) -> DataFrame:
    """Rated items in the stream's state: filled once from the history, then by each
    message, over two restarts."""
    return _flat(RS.latest_recs(spark, run_stream(spark, d, rated_in_state=True)))


RECENT_ORACLE = with_(msg=MESSAGES_SQL) + f"""
, o AS (SELECT uid, mid, score,
               row_number() OVER (PARTITION BY uid ORDER BY {MESSAGE_ORDER_SQL}) AS rn FROM msg)
SELECT uid, CAST(rn AS INTEGER) AS rank, mid, score FROM o WHERE rn <= 20"""


@query("stream_recent", RECENT_ORACLE)
def q_stream_recent(spark: SparkSession, d: str) -> DataFrame:
    return RS.latest_recents(spark, run_stream(spark, d))


@query("state_recents", RECENT_ORACLE)
def q_state_recents(spark: SparkSession, d: str) -> DataFrame:
    """The recents read from the state store, not from the stream's output."""
    return RS.state_recents(spark, checkpoint_of(run_stream(spark, d)))


@query("state_rated", with_(msg=MESSAGES_SQL, r=RATINGS_SQL) + """
SELECT uid, mid FROM r UNION SELECT uid, mid FROM msg""")
def q_state_rated(spark: SparkSession, d: str) -> DataFrame:
    """Rated items of every user, of the history and of all messages, from the state store."""
    return RS.state_rated(spark, checkpoint_of(run_stream(spark, d, rated_in_state=True)))


@query("compacted_recents", RECENT_ORACLE)
def q_compacted_recents(spark: SparkSession, d: str) -> DataFrame:
    """Four batches of recents as the stream writes them (a row set for each user
    with a message in it), the first two folded into a first snapshot, the third
    into the buckets it touches, and the fourth read beside it."""
    out = shared_dir(spark, "compacted")
    msgs = A.messages(spark, d)
    cuts = msgs.approxQuantile("msg_id", [0.25, 0.5, 0.75], 0.001)
    for batch, (lo, hi) in enumerate(zip([None, *cuts], [*cuts, None])):
        upto = msgs if hi is None else msgs.where(F.col("msg_id") <= hi)
        users = upto if lo is None else upto.where(F.col("msg_id") > lo)
        rerank.recents_from_messages(upto).join(history.distinct_users(users), "uid", "left_semi") \
            .write.mode("overwrite").parquet(f"{out}/recents/batch_id={batch}")
        if batch in (1, 2):
            RS.compact(spark, out, "recents", buckets=history.MIN_BUCKETS)
    return RS.latest_recents(spark, out)
