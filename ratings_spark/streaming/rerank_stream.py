"""The real-time re-rank job on Structured Streaming.

    messages (Kafka or files)  ->  parse  ->  per-user recents state
        ->  foreachBatch: candidates + scores (joins against static tables)
        ->  per-batch directories  <out>/recs/batch_id=<n>/
                                   <out>/recents/batch_id=<n>/

Each batch directory is written with overwrite, so a batch replayed after a
failure replaces its own output instead of duplicating it. Every user with
a message in the batch gets a row (an empty list when there is nothing to
recommend), which supersedes the user's older rows: readers take the
highest ``batch_id`` per user (``latest_recs``). The similarity table and
the rated set are looked up anew every batch, their layout included, so a
refreshed offline run is picked up without restarting. Messages that can't be
parsed go to a reject table (``reject_sink``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ratings_spark.constants import CANDIDATES_N, RECENT_RATINGS_N, SIM_THRESHOLD
from ratings_spark.functions.lists import encode_recs
from ratings_spark.operators import history, rerank
from ratings_spark.operators.topk import top_k
from ratings_spark.session import ship_package
from ratings_spark.sources.text import flag_messages
from ratings_spark.streaming import versions
from ratings_spark.streaming.recents import (
    CHUNK_BITS, LIST_IDS, LIST_KEY, OUTPUT_SCHEMA, RATED_OUTPUT_SCHEMA, RecentAndRated, RecentRatings)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EMPTY_RECS = "array<struct<mid:bigint,r:double>>"
RATED = (("uid", "bigint"), ("mid", "bigint"))
EDGES = (("mid", "bigint"), ("other_mid", "bigint"), ("sim", "double"))
# Tasks a hot item's users are spread over: a stateful query runs its batches
# without adaptive execution, which would split such a join task.
SALTS = 8


@dataclass(frozen=True)
class RatedInState:
    """Keep the rated items of each user in the stream's own state, instead of
    looking them up in a table every batch. ``history`` (uid, mid) fills the state
    in the query's first batch and is not read afterwards; each message adds its
    item. Rows with a null in either column are left out."""

    history: DataFrame | None = None

    def chunks(self) -> DataFrame | None:
        """(uid, chunk, mids): the history in rows of bounded length."""
        if self.history is None:
            return None
        return self._pairs().groupBy("uid", F.shiftright("mid", CHUNK_BITS).alias("chunk")) \
            .agg(F.collect_set("mid").alias("mids"))

    def _pairs(self) -> DataFrame:
        return self.history.select(F.col("uid").cast("long").alias("uid"), F.col("mid").cast("long").alias("mid")).dropna()

    def entries(self) -> DataFrame | None:
        """(uid, chunk, mids) as the state keeps them: each user's least ``LIST_IDS`` ids
        in one row, as ids far apart would make a row each of ``chunks``, and the others
        in chunks. One shuffle, by user."""
        if self.history is None:
            return None
        place = F.dense_rank().over(Window.partitionBy("uid").orderBy("mid"))
        chunk = F.when(F.col("_place") <= LIST_IDS, F.lit(LIST_KEY)).otherwise(F.shiftright("mid", CHUNK_BITS))
        return self._pairs().withColumn("_place", place).groupBy("uid", chunk.alias("chunk")) \
            .agg(F.collect_set("mid").alias("mids"))


def flagged_messages(spark: SparkSession, fmt: str = "text", path: str | None = None,
                     options: dict | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of all messages: value, the parsed fields and reason
    (null for a good message).

    ``fmt='kafka'`` reads the record value (``options`` carry
    ``kafka.bootstrap.servers`` and ``subscribe``; the Kafka connector must
    be on the classpath -- it is not in the test environment); a record's
    partition and offset stand in for a missing message id, so messages of the
    same second keep the order of their partition. ``fmt='text'`` reads new
    files under ``path``."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.load(path) if path else r.load()
    value = F.col("value").cast("string").alias("value")
    if fmt != "kafka":
        return flag_messages(raw.select(value))
    place = (F.shiftleft(F.col("partition").cast("long"), 44) + F.col("offset")).alias("place")
    rows = flag_messages(raw.select(value, place), "place")
    return rows.withColumn("msg_id", F.coalesce("msg_id", "place")).drop("place")


def message_stream(spark: SparkSession, fmt: str = "text", path: str | None = None,
                   options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """The good messages (uid, mid, score, timestamp, msg_id) of
    ``flagged_messages``; ``reject_sink`` keeps the others."""
    rows = flagged_messages(spark, fmt, path, options, max_files_per_trigger)
    return rows.where("reason IS NULL").select("uid", "mid", "score", "timestamp", "msg_id")


def reject_sink(flagged: DataFrame, path: str, checkpoint: str,
                trigger: dict | None = None) -> StreamingQuery:
    """Append the messages of ``flagged_messages`` that can't be parsed, with
    the reason, to a parquet table (exactly-once file sink)."""
    return flagged.where("reason IS NOT NULL").select("value", "reason").writeStream \
        .format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def with_recents(messages: DataFrame, n: int = RECENT_RATINGS_N,
                 rated: RatedInState | None = None) -> DataFrame:
    """Attach per-user recents state (``RecentRatings``, with ``rated``
    ``RecentAndRated``) to the message stream.

    The processor is pickled by value: the driver-side runner that
    initialises it does not see ``addPyFile`` includes."""
    from pyspark import cloudpickle

    from ratings_spark.streaming import recents as recents_module
    cloudpickle.register_pickle_by_value(recents_module)
    spark = messages.sparkSession
    ship_package(spark)
    reduced = messages.select("uid", "mid", "score", "timestamp", "msg_id").mapInPandas(
        recents_module.newest_per_batch(n, every_item=rated is not None), recents_module.MESSAGE_SCHEMA)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    by_user = reduced.groupBy("uid")
    if rated is None:
        return by_user.transformWithState(
            statefulProcessor=RecentRatings(n), outputStructType=OUTPUT_SCHEMA,
            outputMode="Update", timeMode="None")
    first = rated.entries()
    return by_user.transformWithState(
        statefulProcessor=RecentAndRated(n), outputStructType=RATED_OUTPUT_SCHEMA,
        outputMode="Update", timeMode="None",
        initialState=None if first is None else first.groupBy("uid"))


def batch_writer(out_dir: str, sim_edges, rated, n_candidates: int = CANDIDATES_N,
                 threshold: float = SIM_THRESHOLD, n_recent: int = RECENT_RATINGS_N,
                 include_incoming: bool = True):
    """The ``foreachBatch`` body: set-based re-rank of one micro-batch.

    The batch (the state operator's output) feeds two writes, so it is
    persisted for the body's duration. The similarity table (symmetric, as
    ``item_similarity`` writes it) and the rated set are a ``BucketedTable``
    (the rated set also a list of them), of which only the batch's buckets
    are read, or a callable giving a DataFrame. With ``RatedInState`` the rated
    set comes with the batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        whole = batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            in_state = isinstance(rated, RatedInState)
            wanted = [(sim_edges, ["mid", "trig_mid"], EDGES)]
            if in_state:
                seen = batch.where("rated IS NOT NULL").select("uid", F.explode("rated").alias("mid"))
                batch = batch.where("rated IS NULL").drop("rated")
            else:
                wanted.append((rated, ["uid"], RATED))
            kept = batch.select("uid", "rank", "mid", "score")
            if include_incoming:
                recents = kept
            else:
                older = batch.where(~F.col("is_trigger"))
                recents = top_k(older, ["uid"], [F.asc("rank")], n_recent) \
                    .select("uid", "rank", "mid", "score")
                kept = kept.where(F.col("rank") <= n_recent)
            triggers = batch.select("uid", F.col("trig_mid").alias("mid")).distinct()
            # Items of recent lists and trigger items (a late or excluded
            # trigger need not be among the recents). The similarity table is
            # symmetric, so edges keyed by those items serve both the
            # candidate lookup and the scoring lookup.
            edges, *found = history.lookup(batch, wanted)
            if not in_state:
                seen, = found
            cands = rerank.unseen_neighbours(triggers, edges, seen, n_candidates, threshold, SALTS)
            flipped = edges.select(F.col("other_mid").alias("mid"),
                                   F.col("mid").alias("other_mid"), "sim")
            scores = rerank.rerank_scores(cands, recents, flipped, threshold, salts=SALTS)
            nested = rerank.nested_recs(scores)
            recs = triggers.select("uid").join(nested, "uid", "left").select(
                "uid", F.coalesce("recs", F.array().cast(EMPTY_RECS)).alias("recs"))
            recs = recs.withColumn("recs_text", encode_recs("recs"))
            recs.write.mode("overwrite").parquet(f"{out_dir}/recs/batch_id={batch_id}")
            kept.write.mode("overwrite").parquet(f"{out_dir}/recents/batch_id={batch_id}")
        finally:
            whole.unpersist()
    return write


def start(messages: DataFrame, out_dir: str, checkpoint: str,
          sim_edges, rated, trigger: dict | None = None, n_recent: int = RECENT_RATINGS_N,
          n_candidates: int = CANDIDATES_N, threshold: float = SIM_THRESHOLD,
          query_name: str | None = None, include_incoming: bool = True,
          state_partitions: int | None = None) -> StreamingQuery:
    """Start the job. ``trigger`` defaults to a 2-second micro-batch
    (``{'processingTime': '2 seconds'}``); tests use ``{'availableNow': True}``.

    ``state_partitions`` sets the shuffle partitions of this query only (the
    state store's partition count, fixed by the checkpoint at first start,
    and the per-batch joins, which run without AQE in a stateful query). The
    query snapshots the session's configuration when it starts, so the
    session's own setting is restored right after.

    No join of this query is a broadcast unless a hint asks for one: without
    adaptive execution the choice would rest on the compressed size of files and
    cached batches, while the rows (the similarity table for every salt, the rated
    items, the orders of a history) grow with the input and would be collected on
    the driver.
    """
    kept_n = n_recent if include_incoming else n_recent + 1
    in_state = rated if isinstance(rated, RatedInState) else None
    w = with_recents(messages, kept_n, in_state).writeStream \
        .foreachBatch(batch_writer(out_dir, sim_edges, rated, n_candidates, threshold,
                                   n_recent, include_incoming)) \
        .option("checkpointLocation", checkpoint) \
        .outputMode("update") \
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
    if query_name:
        w = w.queryName(query_name)
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    if state_partitions is not None:
        own["spark.sql.shuffle.partitions"] = str(state_partitions)
    spark = messages.sparkSession
    old = {key: spark.conf.get(key) for key in own}
    try:
        for key, value in own.items():
            spark.conf.set(key, value)
        return w.start()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def ratings_sink(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                 buckets: int = history.MIN_BUCKETS) -> StreamingQuery:
    """Append every parsed incoming rating to a table bucketed by user
    (exactly-once file sink), to be given to ``start`` beside the history's
    rated table: ``rated=[history, sink]``. The two need not have the same
    number of buckets."""
    rows = history.clustered_by_bucket(
        messages.select("uid", "mid", "score", "timestamp", "msg_id"), "uid", buckets)
    return rows.writeStream.format("parquet").option("path", path) \
        .option("checkpointLocation", checkpoint).partitionBy("uid_buckets", "uid_bucket") \
        .outputMode("append").trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def compact(spark: SparkSession, out_dir: str, table: str = "recs", buckets: int | None = None) -> int:
    """Fold the batches of ``table`` since the last compaction into a snapshot by
    user bucket, of which only the buckets they touch are rewritten
    (``versions.compact``). Returns the last batch id covered."""
    return versions.compact(spark, f"{out_dir}/{table}", buckets)


def latest_recs(spark: SparkSession, out_dir: str) -> DataFrame:
    """(uid, recs, recs_text, batch_id): each user's current list."""
    return versions.current(spark, f"{out_dir}/recs")


def latest_recents(spark: SparkSession, out_dir: str) -> DataFrame:
    """(uid, rank, mid, score): each user's recents after the latest batch."""
    return versions.current(spark, f"{out_dir}/recents").select("uid", "rank", "mid", "score")


def _state(spark: SparkSession, checkpoint: str, variable: str, batch_id: int | None) -> DataFrame:
    """Rows of a state variable, read from the store below the query's checkpoint."""
    r = spark.read.format("statestore").option("stateVarName", variable)
    if batch_id is not None:
        r = r.option("batchId", str(batch_id))
    return r.load(checkpoint)


def state_recents(spark: SparkSession, checkpoint: str, n: int = RECENT_RATINGS_N,
                  batch_id: int | None = None) -> DataFrame:
    """(uid, rank, mid, score): each user's ``n`` newest ratings as the stream's state
    holds them after the last committed batch, or after ``batch_id`` while its state is
    retained. No table of recents is needed; lists are short, as the state is."""
    rows = _state(spark, checkpoint, "recent", batch_id).select("key.uid", "list_element.*")
    order = [F.desc("timestamp"), F.desc(F.coalesce("msg_id", F.lit(-1))), F.asc("mid"), F.asc("score")]
    return top_k(rows, ["uid"], order, n).select("uid", "rank", "mid", "score")


def state_rated(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """(uid, mid): the rated items in the state of a stream started with ``RatedInState``."""
    return _state(spark, checkpoint, "rated", batch_id) \
        .select("key.uid", F.explode("user_map_value.mids").alias("mid"))
