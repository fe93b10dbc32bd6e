"""Real-time re-ranking, batch form (the streaming job runs the same code
per micro-batch).

For a user's latest rating message on item m:

1. candidates: items similar to m (sim > threshold), minus items the user
   has already rated (left anti join), best ``n_candidates`` by similarity;
2. each candidate c is scored against the user's recent ratings q with
   sim(c, q) > threshold (P):

       score(c) = sum_{q in P} sim(c,q) * rating(q) / |P|
                + log2(max(1, #{q in P: rating(q) > 3}))
                - log2(max(1, #{q in P: rating(q) <= 3}))

   A candidate with empty P gets no score. (The original threw when either
   count was zero; a zero count adds nothing here.)

Every step is an equi-join or an aggregation keyed by user; a message is
never processed row-by-row, and nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ratings_spark.constants import CANDIDATES_N, POSITIVE_RATING, RECENT_RATINGS_N, SIM_THRESHOLD
from ratings_spark.operators.topk import latest, top_k

def message_order():
    """Newest first; the message id orders messages of the same second."""
    return [F.desc("timestamp"), F.desc("msg_id")]


def latest_messages(messages: DataFrame) -> DataFrame:
    """(uid, mid, score, timestamp, msg_id): each user's newest message."""
    return latest(messages, ["uid"], message_order())


def recents_from_messages(messages: DataFrame, n: int = RECENT_RATINGS_N) -> DataFrame:
    """(uid, rank, mid, score): each user's n newest rated items (the
    incoming message included), newest first."""
    return top_k(messages, ["uid"], message_order(), n).select("uid", "rank", "mid", "score")


def ranked_neighbours(sim_edges: DataFrame, threshold: float = SIM_THRESHOLD) -> DataFrame:
    """(mid, other_mid, sim, rank): each item's neighbours above the threshold,
    most similar first, ties by id. A table that has the rank keeps it."""
    e = sim_edges.where(F.col("sim") > threshold)
    if "rank" in e.columns:
        return e.select("mid", "other_mid", "sim", "rank")
    w = Window.partitionBy("mid").orderBy(F.desc("sim"), F.asc("other_mid"))
    return e.select("mid", "other_mid", "sim", F.row_number().over(w).alias("rank"))


def flipped(sim_edges: DataFrame) -> DataFrame:
    """The edges in the other direction: of a symmetric table that was cut to the
    items of recent lists and triggers, those that scoring looks up."""
    return sim_edges.select(F.col("other_mid").alias("mid"), F.col("mid").alias("other_mid"), "sim")


def candidate_pairs(triggers: DataFrame, sim_edges: DataFrame, rated_pairs: DataFrame,
                    n: int = CANDIDATES_N, threshold: float = SIM_THRESHOLD,
                    salts: int = 1) -> DataFrame:
    """(uid, mid, sim): of each trigger item's neighbours the first n + r, where
    r is the number of items its user has rated. At most r of them fall to
    the anti join, so the best n unseen ones are always among them, and a
    popular item's whole neighbour list is never expanded for each user.

    ``salts`` spreads a hot trigger item over that many join tasks by the
    neighbour's rank, for plans that adaptive execution can't split."""
    # Counted for all users of the table: a semi join with the triggers would be
    # pushed below the caller's de-duplication, whose shuffle then serves only
    # one of its two uses.
    r = rated_pairs.groupBy("uid").agg(F.count("*").alias("_r"))
    t = triggers.select("uid", F.col("mid").alias("src")).join(r, "uid", "left") \
        .select("uid", "src", (F.coalesce("_r", F.lit(0)) + n).alias("_upto"))
    e = ranked_neighbours(sim_edges, threshold) \
        .select(F.col("mid").alias("src"), F.col("other_mid").alias("mid"), "sim", "rank")
    keys = ["src"]
    if salts > 1:
        keys = ["src", "_salt"]
        t = t.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        e = e.withColumn("_salt", F.col("rank") % salts)
    return t.join(e, keys).where(F.col("rank") <= F.col("_upto")).select("uid", "mid", "sim")


def unseen_neighbours(triggers: DataFrame, sim_edges: DataFrame, rated: DataFrame,
                      n: int = CANDIDATES_N, threshold: float = SIM_THRESHOLD,
                      salts: int = 1) -> DataFrame:
    """(uid, rank, mid, sim): per trigger (uid, mid), the n most similar items
    the user has not rated. An item without neighbours yields no rows.

    ``rated`` may repeat (uid, mid) pairs. They are de-duplicated first: the
    partial aggregate collapses copies map-side, and its hash partitioning on
    (uid, mid) is the one the anti join needs, while a pair repeated a
    million times no longer reaches one join task a million times. Nulls, which match
    nothing, are left out before it: the anti join would leave them out on its side
    alone, and the two uses would then not share the shuffle."""
    pairs = rated.select("uid", "mid").where("uid IS NOT NULL AND mid IS NOT NULL").distinct()
    c = candidate_pairs(triggers, sim_edges, pairs, n, threshold, salts)
    c = c.join(pairs, ["uid", "mid"], "left_anti")
    return top_k(c, ["uid"], [F.desc("sim"), F.asc("mid")], n).select("uid", "rank", "mid", "sim")


def rerank_scores(candidates: DataFrame, recents: DataFrame, sim_edges: DataFrame,
                  threshold: float = SIM_THRESHOLD,
                  positive: float = POSITIVE_RATING, salts: int = 1) -> DataFrame:
    """(uid, mid, score) per candidate with at least one similar recent item.
    ``salts`` spreads item pairs that many users share over that many tasks."""
    c = candidates.select("uid", F.col("mid").alias("cand"))
    r = recents.select("uid", F.col("mid").alias("rmid"), F.col("score").alias("rscore"))
    e = sim_edges.where(F.col("sim") > threshold) \
        .select(F.col("mid").alias("cand"), F.col("other_mid").alias("rmid"), "sim")
    x, keys = c.join(r, "uid"), ["cand", "rmid"]
    if salts > 1:
        keys = keys + ["_salt"]
        x = x.withColumn("_salt", F.pmod(F.xxhash64("uid"), F.lit(salts)).cast("int"))
        e = e.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    x = x.join(e, keys)
    g = x.groupBy("uid", "cand").agg(
        F.avg(F.col("sim") * F.col("rscore")).alias("base"),
        F.count_if(F.col("rscore") > positive).alias("n_pos"),
        F.count_if(F.col("rscore") <= positive).alias("n_neg"))
    score = (F.col("base") + F.log2(F.greatest(F.col("n_pos"), F.lit(1)))
             - F.log2(F.greatest(F.col("n_neg"), F.lit(1))))
    return g.select("uid", F.col("cand").alias("mid"), score.alias("score"))


def rerank(messages: DataFrame, sim_edges: DataFrame, rated: DataFrame,
           n_recent: int = RECENT_RATINGS_N, n_candidates: int = CANDIDATES_N,
           threshold: float = SIM_THRESHOLD, recents: DataFrame | None = None,
           include_incoming: bool = True, score_edges: DataFrame | None = None) -> DataFrame:
    """Batch re-rank: (uid, mid, score) for every user's latest message.

    ``recents`` defaults to the newest ratings among ``messages`` -- one
    ranking window gives both the recents and (rank 1) the trigger; pass a
    table (uid, mid, score) to use a different history.
    ``include_incoming=False`` scores against the ``n_recent`` ratings before
    the incoming one. ``score_edges`` are looked up for the scores instead of ``sim_edges``.
    """
    if recents is None:
        if n_recent < 1:
            raise ValueError("n_recent must be >= 1")
        extra = 0 if include_incoming else 1
        rec = recents_from_messages(messages, n_recent + extra)
        trig = rec.where(F.col("rank") == 1).select("uid", "mid")
        if not include_incoming:
            rec = rec.where(F.col("rank") > 1).withColumn("rank", F.col("rank") - 1)
    else:
        rec = recents
        trig = latest_messages(messages)
    cands = unseen_neighbours(trig, sim_edges, rated, n_candidates, threshold)
    return rerank_scores(cands, rec, sim_edges if score_edges is None else score_edges, threshold)


def nested_recs(scores: DataFrame) -> DataFrame:
    """(uid, recs array<struct<mid, r>>) per user, best first (ties by mid).

    One aggregation: lists are bounded by the candidate count, and sorting
    structs (-score, mid) orders them without a window."""
    items = F.struct((-F.col("score")).alias("_k"), F.col("mid").alias("mid"),
                     F.col("score").alias("r"))
    g = scores.groupBy("uid").agg(F.array_sort(F.collect_list(items)).alias("_l"))
    return g.select("uid", F.transform(
        "_l", lambda x: F.struct(x["mid"].alias("mid"), x["r"].alias("r"))).alias("recs"))


def latest_version(rows: DataFrame, key: str = "uid", version: str = "batch_id") -> DataFrame:
    """Rows of the highest ``version`` per ``key`` (a replace-per-key table
    kept as append-only versions). The max is a map-side-combined
    aggregation; the rows are then kept by a semi join."""
    newest = rows.groupBy(key).agg(F.max(version).alias(version))
    return rows.join(newest, [key, version], "left_semi")
