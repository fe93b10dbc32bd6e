"""Per-user recent-ratings state for the message stream.

``RecentRatings`` is a ``transformWithState`` processor (row form) keyed by
user. It keeps the user's ``n`` newest ratings (mid, score, timestamp,
msg_id) in list state and, for every user with messages in the micro-batch,
emits the updated list together with the user's newest message of the batch
(the trigger of the re-rank). Order is by (timestamp, msg_id), not arrival,
so a replayed or late file converges to the same list; a message id seen
twice is kept once.

Input rows of one user arrive as an iterator; only a running top-n is held, so
a very active user does not need memory proportional to their batch.

``RecentAndRated`` also keeps the items each user has rated, in map state: the first
``LIST_IDS`` of them in one list (``LIST_KEY``), so that most users have a single
entry however far apart their ids are, and further ones in chunks; a chunk holds the
rated ids that agree but for their last ``CHUNK_BITS`` bits, so at most 4096, whoever
the user. It is filled once from the history (initial state) and then by each message,
and the entries of the batch's users are emitted with their recents: no table of rated
items is read per batch. A user whose state has chunks and no list (a state of the
former layout) goes on with chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ratings_spark.constants import RECENT_RATINGS_N

STATE_SCHEMA = T.StructType([
    T.StructField("mid", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("msg_id", T.LongType()),
])

OUTPUT_SCHEMA = T.StructType([
    T.StructField("uid", T.LongType()),
    T.StructField("trig_mid", T.LongType()),
    T.StructField("trig_timestamp", T.LongType()),
    T.StructField("trig_msg_id", T.LongType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("mid", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("msg_id", T.LongType()),
    T.StructField("is_trigger", T.BooleanType()),
])

# With the rated items: such rows have no rank, the others no ``rated``.
RATED_OUTPUT_SCHEMA = T.StructType(
    OUTPUT_SCHEMA.fields + [T.StructField("rated", T.ArrayType(T.LongType()))])

CHUNK_BITS = 12
# Ids of a user's list, and its key: no chunk's number, as these have CHUNK_BITS bits less.
LIST_IDS = 4096
LIST_KEY = -(1 << 62)
CHUNK_KEY = T.StructType([T.StructField("chunk", T.LongType())])
CHUNK_VALUE = T.StructType([T.StructField("mids", T.ArrayType(T.LongType()))])
# Ids of one user held at once before they go into the state.
HELD_IDS = 65_536

MESSAGE_SCHEMA = T.StructType([T.StructField("uid", T.LongType())] + list(STATE_SCHEMA.fields))

_COLS = ["mid", "score", "timestamp", "msg_id"]


def newest_per_batch(n: int = RECENT_RATINGS_N, every_item: bool = False):
    """``mapInPandas`` body: each user's ``n`` newest messages of one Arrow
    batch (with ``every_item`` also one message of each other item), a combine before the shuffle by user. Batches are reduced on their
    own (the state merges what several leave), so memory and time follow the
    batch size, not the number of users in the partition."""
    cols = ["uid"] + _COLS

    def fn(batches):
        for b in batches:
            b = b[cols].astype({"uid": "int64", "mid": "int64", "score": "float64",
                                "timestamp": "int64", "msg_id": "Int64"})
            b = b[b["msg_id"].isna() | ~b.duplicated(["uid", "msg_id"])]
            tie = b["msg_id"].fillna(-1).astype("int64")
            order = b.assign(_tie=tie).sort_values(
                ["uid", "timestamp", "_tie"], ascending=[True, False, False], kind="mergesort")
            keep = order.groupby("uid", sort=False).cumcount() < n
            if every_item:
                keep |= ~order.duplicated(["uid", "mid"])
            yield order.loc[keep, cols]
    return fn


def newest(items, n: int) -> list:
    """The n newest of (mid, score, timestamp, msg_id) tuples, newest first;
    one item a message id. Items without an id come after those with one in
    the same second, then in the order of item and score."""
    seen, out = set(), []
    for x in sorted(items, key=lambda x: (-x[2], -(-1 if x[3] is None else x[3]), x[0], x[1])):
        if x[3] is not None:
            if x[3] in seen:
                continue
            seen.add(x[3])
        out.append(x)
        if len(out) == n:
            break
    return out


class RecentRatings(StatefulProcessor):
    def __init__(self, n: int = RECENT_RATINGS_N):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.items = handle.getListState("recent", STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        batch: list = []
        for r in rows:
            batch.append((r["mid"], r["score"], r["timestamp"], r["msg_id"]))
            if len(batch) >= 8 * self.n:
                batch = newest(batch, self.n)
        if not batch:
            return
        batch = newest(batch, self.n)
        trigger = batch[0]
        stored = [tuple(x) for x in self.items.get()]
        merged = newest(batch + stored, self.n)
        self.items.put(merged)
        # The trigger is known by its place, as messages need not have ids.
        at = merged.index(trigger) if trigger in merged else -1
        for k, (mid, score, _, msg_id) in enumerate(merged):
            yield Row(uid=key[0], trig_mid=trigger[0], trig_timestamp=trigger[2],
                      trig_msg_id=trigger[3], rank=k + 1, mid=mid, score=score, msg_id=msg_id,
                      is_trigger=k == at)

    def close(self) -> None:
        pass


class RecentAndRated(RecentRatings):
    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.rated = handle.getMapState("rated", CHUNK_KEY, CHUNK_VALUE)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        # A user's rows have an entry each: nothing is there to look up.
        self.rated.updateValue((initialState["chunk"],), (sorted(initialState["mids"]),))

    def _add(self, chunk: int, mids) -> None:
        stored = self.rated.getValue((chunk,)) if self.rated.containsKey((chunk,)) else None
        before = set(stored[0]) if stored is not None else set()
        if not before.issuperset(mids):
            self.rated.updateValue((chunk,), (sorted(before.union(mids)),))

    def _add_all(self, held: set) -> None:
        if self.rated.containsKey((LIST_KEY,)):
            stored = self.rated.getValue((LIST_KEY,))[0]
        else:
            stored = None if next(iter(self.rated.values()), None) is not None else []
        if stored is not None:
            held.difference_update(stored)
            # Chunks are begun when the list is full, so none of them has an id of the list.
            put = sorted(held)[:max(0, LIST_IDS - len(stored))]
            if put:
                self.rated.updateValue((LIST_KEY,), (sorted([*stored, *put]),))
                held.difference_update(put)
        chunks: dict = {}
        for mid in held:
            chunks.setdefault(mid >> CHUNK_BITS, []).append(mid)
        for chunk, mids in chunks.items():
            self._add(chunk, mids)
        held.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held: set = set()

        def noted():
            for r in rows:
                held.add(r["mid"])
                if len(held) >= HELD_IDS:
                    self._add_all(held)
                yield r

        trigger = None
        for r in super().handleInputRows(key, noted(), timerValues):
            trigger = r
            yield Row(**r.asDict(), rated=None)
        if trigger is None:
            return
        self._add_all(held)
        for mids, in self.rated.values():
            yield Row(uid=key[0], trig_mid=None, trig_timestamp=None, trig_msg_id=None, rank=None,
                      mid=None, score=None, msg_id=None, is_trigger=None, rated=list(mids))
