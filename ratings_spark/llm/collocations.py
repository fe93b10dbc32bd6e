"""Phrase collocations from depth-truncated suffix trees, partitioned vertically.

Texts are sequences of words within pieces; each word begins a suffix, of which the
first ``DEPTH`` words matter. The tree of these suffixes, cut at that depth, has a node
for every phrase, and the suffixes below a node are the phrase's occurrences. It is
never built whole:

1. Words are counted. A word of fewer than ``min_count`` occurrences is in no phrase
   asked for, so it ends a suffix like the end of a piece does. Tasks know the frequent
   words by a bit table of fixed size, ``FILTER_BITS``; a word let through by chance
   costs space, not exactness.
2. Tasks write their suffixes as chunks: distinct paths with their number, in local
   16-bit word codes (``suffix_chunks``). A pair of words, then three, of fewer than
   ``min_count`` occurrences is in no phrase asked for either: paths are cut before
   its last word, again by a bit table, and what is left is joined to fuller chunks
   (``pruned``).
3. Vertical partitioning: a prefix of words with more than ``budget`` distinct paths is
   lengthened by a word (at last by the chunk), until every prefix fits; prefixes are
   then grouped up to the budget (``partition``).
4. Each group's paths are sent to one task, which sorts them and reads the count of
   every node from the totals of the leaves below it (``subtree_counts``), on its own.
   Nodes above a lengthened prefix have their leaves in several groups; their parts
   are added up.

Words are known by 64-bit hashes. Two words with one hash in a language are found while
words are counted; such hashes become taboo, and the words take the next hash.

A candidate is a phrase of 2 to ``DEPTH`` words with a count a >= ``min_count``. Each
cut after its first k words gives floor(2000000 a / (l + r)), l and r being the counts
of the parts; the lowest counts (then the smallest k). Candidates whose words lie inside
a longer one of at least ``cover`` percent of their count are dropped, and each language's
first ``top`` by score, count and phrase returned.

Defined results: null and empty texts have no words; a null language is ``und``, one
with the rows so labelled. Only A-Z are lower-cased. Repeated rows count as often as
they stand; ties are ordered by phrase in UTF-8 bytes. A language without candidates has
no rows, nor has an empty table. Other columns are not looked at. Long texts are cut into
slices that overlap by the words a suffix needs.

Scale: a chunk and group hold at most ``CHUNK`` words and some ``budget`` paths; the
prefixes that reach tasks are at most words / budget, 64-bit each, and can be lessened
by a larger budget. Beyond some thousand groups a chunk sends few paths a group, and
rows grow towards 60 bytes a path.
"""

from __future__ import annotations

from collections import Counter
from contextlib import contextmanager
from itertools import islice
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, shared_dir, ship_package

DEPTH = 4  # words of a path; a path is one 64-bit number of 16-bit codes
MIN_COUNT, COVER, TOP = 30, 80, 2000
BUDGET = 500_000  # paths of a group of prefixes
CHUNK = 250_000   # words of a chunk
FILTER_BITS = 27
BATCH_BYTES = 8 << 20  # of rows sent to Python together
_SLICE = 1 << 17    # bytes of a text looked at together: fewer than 65,535 distinct words
_CODES = 65_535
_FLUSH = 200_000    # distinct words counted before they leave a task
_ROWS = 20_000      # rows of them sent together
_BINS = 1 << 16
_PIECE_END = b"\n"
_BYTES = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


def word_id(word: bytes, taboo=frozenset(), digest=xxhash.xxh64_intdigest) -> int:
    """Signed 64-bit id of a word: its first hash that is neither taboo nor 0."""
    seed = 0
    while True:
        h = digest(word, seed)
        h = h - (1 << 64) if h >> 63 else h
        if h and h not in taboo:
            return h
        seed += 1


def _tokens(data: bytes) -> list[bytes]:
    """Words, and ``_PIECE_END`` between pieces; may hold empty strings."""
    return data.replace(b"\n", b" \n ").split(b" ")


def slices(text: bytes):
    """(tokens, number of them that begin a suffix) of bounded parts of a text; the
    tokens after these are the beginnings of the next part."""
    data = text.lower().translate(_BYTES)
    at = 0
    while len(data) - at > _SLICE:
        ends = [e for e in (data.find(b" ", at + _SLICE), data.find(b"\n", at + _SLICE)) if e >= 0]
        if not ends:
            break
        cut, width, ahead = min(ends), 256, []
        while True:
            ahead = [t for t in _tokens(data[cut:cut + width]) if t]
            if cut + width >= len(data):
                break
            ahead = ahead[:-1]  # may be part of a word
            if len(ahead) >= DEPTH - 1:
                break
            width *= 4
        own = [t for t in _tokens(data[at:cut]) if t]
        yield own + ahead[:DEPTH - 1], len(own)
        at = cut
    own = [t for t in _tokens(data[at:]) if t]
    yield own, len(own)


def _texts(batch):
    """(language, text) of each row with a text."""
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
        if text.is_valid:
            yield lang, text.as_py()


def _emit_words(taboo, digest):
    def tables(counts, totals):
        def rows():
            for lang, c in counts.items():
                for w, n in c.items():
                    yield lang, word_id(w, taboo, digest), w, n
            for lang, n in totals.items():
                yield lang, 0, None, n
        rows = rows()
        while part := list(islice(rows, _ROWS)):
            lang, ids, words, n = zip(*part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(ids, pa.int64()), pa.array(words, pa.binary()).view(pa.string()),
                 pa.array(n, pa.int64())], names=["lang", "id", "word", "n"])

    def run(batches):
        counts, totals = {}, Counter()
        for batch in batches:
            for lang, text in _texts(batch):
                for tokens, own in slices(text):
                    c = counts.setdefault(lang, Counter())
                    c.update(tokens[:own])
                    totals[lang] += own - c.pop(_PIECE_END, 0)
                    if sum(map(len, counts.values())) > _FLUSH:
                        yield from tables(counts, {})
                        counts = {}
        yield from tables(counts, totals)
    return run


def vocabulary(rows: DataFrame, min_count: int, digest=xxhash.xxh64_intdigest) -> tuple[DataFrame, frozenset]:
    """(lang, id, word, f) of the frequent words of ``rows`` (lang, text), and with id 0
    each language's number of words; and the taboo hashes."""
    taboo = frozenset()
    while True:
        found = rows.mapInArrow(_emit_words(taboo, digest), "lang string, id long, word string, n long")
        found = (found.groupBy("lang", "id").agg(F.sum("n").alias("f"), F.min("word").alias("word"),
                                                 (F.min("word") != F.max("word")).alias("shared"))
                 .where(f"id = 0 OR shared OR f >= {min_count}"))
        found = materialize(found, "collocation-words")
        # Expected to be none below a billion distinct words, and few beyond.
        shared = {r["id"] for r in found.where("shared").select("id").distinct().toLocalIterator()}
        if not shared:
            return found.select("lang", "id", "word", "f"), taboo
        taboo |= shared


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _tag(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 1))


def _slots(lang: str, ids: np.ndarray, bits: int) -> np.ndarray:
    return _mix(ids.astype(np.int64).view(np.uint64) ^ _tag(lang)) >> np.uint64(64 - bits)


_PAGE = 1 << 18  # bits of the table that are sent together


def _emit_pages(slots_of):
    """Pages of the bit table that have a slot of these rows."""
    def run(batches):
        for batch in batches:
            slots = slots_of(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array((slots // _PAGE).astype(np.int32)), pa.array((slots % _PAGE).astype(np.int32))],
                names=["page", "bit"])
    return run


def word_filter(words: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bit table of the frequent words (packed): of fixed size, whatever their number."""
    def slots_of(batch):
        langs = np.array(batch.column(0).to_pylist(), object)
        ids = batch.column(1).to_numpy()
        return np.concatenate([_slots(x, ids[langs == x], bits) for x in set(langs)] or [np.zeros(0, np.uint64)])
    return _bit_table(words.where("id <> 0").select("lang", "id"), slots_of, bits)


def _bit_table(rows: DataFrame, slots_of, bits: int) -> np.ndarray:
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        on = np.zeros(_PAGE, bool)
        on[pdf["bit"].to_numpy()] = True
        return pd.DataFrame({"page": pdf["page"].iloc[:1], "bits": [np.packbits(on).tobytes()]})
    pages = (rows.mapInArrow(_emit_pages(slots_of), "page int, bit int").distinct()
             .groupBy("page").applyInPandas(pack, "page int, bits binary"))
    out = np.zeros(max(1, 1 << bits >> 3), np.uint8)
    for r in pages.toLocalIterator():
        at, page = r["page"] * (_PAGE >> 3), np.frombuffer(r["bits"], np.uint8)[:len(out)]
        out[at:at + len(page)] = page
    return out


def _in_table(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return ((table[(slots >> np.uint64(3)).astype(np.int64)] >> (7 - (slots & np.uint64(7))).astype(np.uint8)) & 1).astype(bool)


class _Codes(dict):
    """Codes of a language's words in a chunk: 0 ends a suffix, -1 is no word."""

    def __init__(self, lang: str, known, bits: int, identity):
        super().__init__({b"": -1, _PIECE_END: 0})
        self.lang, self.known, self.bits, self.identity, self.ids = lang, known, bits, identity, [0]


def _learn(codes: _Codes, tokens) -> None:
    """Give all new words of a part their codes at once."""
    new = [w for w in set(tokens) if w not in codes]
    if not new:
        return
    ids = np.array([codes.identity(w) for w in new], np.int64)
    slot = _slots(codes.lang, ids, codes.bits)
    frequent = _in_table(codes.known, slot)
    for w, i, f in zip(new, ids.tolist(), frequent.tolist()):
        codes[w] = len(codes.ids) if f else 0
        if f:
            codes.ids.append(i)


def paths_of(codes: np.ndarray, own: int) -> np.ndarray:
    """Paths of two words or more of the suffixes that begin at the first ``own`` codes."""
    ahead = np.concatenate([codes, np.zeros(DEPTH - 1, np.int64)]).astype(np.uint64)
    live, key = np.ones(own, bool), np.zeros(own, np.uint64)
    for k in range(DEPTH):
        c = ahead[k:k + own]
        live &= c != 0
        key = (key << np.uint64(16)) | np.where(live, c, np.uint64(0))
        if k == 1:
            wanted = live.copy()
    return key[wanted]


def _emit_chunks(known, bits, taboo, digest, chunk):
    def identity(word):
        return word_id(word, taboo, digest)

    def rows(pending, coders):
        for lang, parts in pending.items():
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            if len(keys):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()), pa.array([keys.tobytes()], pa.binary()),
                     pa.array([counts.astype(np.uint32).tobytes()], pa.binary()),
                     pa.array([np.array(coders[lang].ids, np.int64).tobytes()], pa.binary())],
                    names=["lang", "paths", "counts", "ids"])

    def run(batches):
        pending, coders, size = {}, {}, 0
        for batch in batches:
            for lang, text in _texts(batch):
                for tokens, own in slices(text):
                    if size > chunk or (lang in coders and len(coders[lang].ids) + own + DEPTH > _CODES
                                        and len(coders[lang].ids) + len(set(tokens)) > _CODES):
                        yield from rows(pending, coders)
                        pending, coders, size = {}, {}, 0
                    if lang not in coders:
                        coders[lang] = _Codes(lang, known, bits, identity)
                    _learn(coders[lang], tokens)
                    codes = np.fromiter(map(coders[lang].__getitem__, tokens), np.int64, len(tokens))
                    pending.setdefault(lang, []).append(paths_of(codes, own))
                    size += own
        yield from rows(pending, coders)
    return run


def suffix_chunks(rows: DataFrame, words: DataFrame, taboo, bits: int = FILTER_BITS, chunk: int = CHUNK,
                  digest=xxhash.xxh64_intdigest) -> DataFrame:
    """(lang, paths, counts, ids): distinct paths of suffixes, in codes that stand for
    ``ids``, with the number of each."""
    emit = _emit_chunks(word_filter(words, bits), bits, taboo, digest, chunk)
    return _write(rows.mapInArrow(emit, "lang string, paths binary, counts binary, ids binary"),
                  "collocation-suffixes")


def _write(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` for large rows: sizes are looked at after every row, where by
    default a page, which readers hold whole, has 100 rows at least."""
    path = shared_dir(df.sparkSession, name)
    sizes = {"parquet.block.size": BATCH_BYTES, "parquet.page.size": 1 << 20}
    checks = {f"parquet.{k}.size.row.check.{m}": 1 for k in ("page", "block") for m in ("min", "max")}
    df.write.options(**sizes, **checks).parquet(path)
    return df.sparkSession.read.parquet(path)


def _read(batch):
    """(lang, paths, counts, ids) of the chunks of a batch."""
    for k in range(batch.num_rows):
        yield (batch.column(0)[k].as_py(), *[np.frombuffer(batch.column(j)[k].as_py(), t)
                                             for j, t in ((1, np.uint64), (2, np.uint32), (3, np.int64))])


def _code(paths: np.ndarray, at: int) -> np.ndarray:
    """Codes of the words at a place of the paths."""
    return ((paths >> np.uint64(16 * (DEPTH - 1 - at))) & np.uint64(0xFFFF)).astype(np.int64)


def _grams(lang: str, paths: np.ndarray, ids: np.ndarray, at: int, k: int) -> np.ndarray:
    """Hashes of the ``k`` words of each path from a place on."""
    known = ids.view(np.uint64)
    h = _mix(known[_code(paths, at)] ^ _tag(lang))
    for j in range(1, k):
        h = _mix(h ^ _mix(known[_code(paths, at + j)] + np.uint64(j)))
    return h


def _summed(paths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paths, ascending, and the sums of their counts."""
    order = np.argsort(paths, kind="stable")
    paths, counts = paths[order], counts[order].astype(np.int64)
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(paths)), bool), paths[1:] != paths[:-1])))
    return paths[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _emit_grams(k: int):
    """(h, n): the first ``k`` words of the paths that have as many."""
    def run(batches):
        for batch in batches:
            for lang, paths, counts, ids in _read(batch):
                first, n = _summed(paths & ~np.uint64((1 << 16 * (DEPTH - k)) - 1), counts)
                whole = _code(first, k - 1) != 0
                h = _grams(lang, first[whole], ids, 0, k)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n[whole])], names=["h", "n"])
    return run


def cut_paths(lang: str, paths: np.ndarray, ids: np.ndarray, k: int, table: np.ndarray, bits: int) -> np.ndarray:
    """Paths that end before the last word of the first ``k`` words not in the table."""
    paths = paths.copy()
    for at in range(DEPTH - k + 1):
        rows = np.flatnonzero(_code(paths, at + k - 1))
        h = _grams(lang, paths[rows], ids, at, k)
        rare = rows[~_in_table(table, h >> np.uint64(64 - bits))]
        paths[rare] &= ~np.uint64((1 << 16 * (DEPTH - at - k + 1)) - 1)
    return paths


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One chunk (paths, counts, ids) of several, with the ids that its paths use."""
    used = []
    for paths, _, ids in parts:
        seen = np.zeros(len(ids), bool)
        for k in range(DEPTH):
            seen[_code(paths, k)] = True
        seen[0] = False
        used.append(ids[seen])
    known = np.unique(np.concatenate(used))
    out = []
    for paths, _, ids in parts:
        codes = np.searchsorted(known, ids).astype(np.uint64) + np.uint64(1)
        codes[0] = 0
        key = np.zeros(len(paths), np.uint64)
        for k in range(DEPTH):
            key = (key << np.uint64(16)) | codes[_code(paths, k)]
        out.append(key)
    paths, counts = _summed(np.concatenate(out), np.concatenate([c for _, c, _ in parts]))
    return paths, counts, np.concatenate((np.zeros(1, np.int64), known))


def _emit_pruned(k: int, table: np.ndarray, bits: int, chunk: int):
    def rows(lang, held):
        paths, counts, ids = held
        # Counts are 32-bit in a chunk: a greater one is dealt over several rows.
        while len(paths):
            now = np.minimum(counts, 0xFFFFFFFF)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.array([paths.tobytes()], pa.binary()),
                 pa.array([now.astype(np.uint32).tobytes()], pa.binary()), pa.array([ids.tobytes()], pa.binary())],
                names=["lang", "paths", "counts", "ids"])
            more = counts > now
            paths, counts = paths[more], (counts - now)[more]

    def run(batches):
        held: dict = {}
        for batch in batches:
            for lang, paths, counts, ids in _read(batch):
                paths = cut_paths(lang, paths, ids, k, table, bits)
                kept = _code(paths, 1) != 0
                if not kept.any():
                    continue
                part, parts = _joined([(paths[kept], counts[kept], ids)]), held.get(lang, [])
                if parts and (sum(len(x[2]) for x in parts) + len(part[2]) > _CODES
                              or sum(len(x[0]) for x in parts) > chunk):
                    whole = _joined(parts)
                    parts = [whole]
                    if len(whole[0]) > chunk // 2 or len(whole[2]) + len(part[2]) > _CODES:
                        yield from rows(lang, whole)
                        parts = []
                held[lang] = parts + [part]
        for lang, parts in held.items():
            yield from rows(lang, _joined(parts))
    return run


def pruned(chunks: DataFrame, k: int, min_count: int, bits: int = FILTER_BITS, chunk: int = CHUNK) -> DataFrame:
    """Chunks whose paths hold no ``k`` words in a row of fewer than ``min_count``
    occurrences, but for those the bit table lets through."""
    grams = chunks.mapInArrow(_emit_grams(k), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    table = _bit_table(grams.where(F.col("n") >= min_count).select("h"), _hash_slots(bits), bits)
    return _write(chunks.mapInArrow(_emit_pruned(k, table, bits, chunk),
                                    "lang string, paths binary, counts binary, ids binary"), "collocation-pruned")


def _hash_slots(bits: int):
    return lambda batch: batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)


def prefixes(lang: str, paths: np.ndarray, ids: np.ndarray, hot) -> tuple[np.ndarray, np.ndarray]:
    """Hash and length of the prefix each path is partitioned by: one word, and one
    more for each of the ``hot`` sets (by length) it is in; the last is the chunk."""
    known = ids.view(np.uint64)
    salt = np.uint64(xxhash.xxh64_intdigest(paths.tobytes(), 2))
    h = _mix(known[(paths >> np.uint64(16 * (DEPTH - 1))).astype(np.int64)] ^ _tag(lang))
    length = np.ones(len(paths), np.int64)
    for k, found in enumerate(hot, 1):
        more = (length == k) & np.isin(h, found)
        if k < DEPTH:
            step = known[((paths >> np.uint64(16 * (DEPTH - 1 - k))) & np.uint64(0xFFFF)).astype(np.int64)]
        else:
            step = np.full(len(paths), salt)
        h = np.where(more, _mix(h ^ _mix(step + np.uint64(k))), h)
        length += more
    return h, length


def _emit_sizes(hot, shift=None):
    """(h, n): paths by prefix, of the prefixes one longer than the hot ones; with
    ``shift`` of all, by the upper bits of the prefix."""
    def run(batches):
        for batch in batches:
            for lang, paths, _, ids in _read(batch):
                h, length = prefixes(lang, paths, ids, hot)
                h = h[length == len(hot) + 1] if shift is None else h >> np.uint64(shift)
                h, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))],
                                                 names=["h", "n"])
    return run


def partition(chunks: DataFrame, budget: int = BUDGET) -> tuple[list[np.ndarray], np.ndarray]:
    """The hot prefixes by length, and the borders of the groups of prefixes: upper
    bits of their hashes up to which a group goes. Both are at most paths / budget."""
    def sizes(hot, shift=None):
        return chunks.mapInArrow(_emit_sizes(hot, shift), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))

    hot: list[np.ndarray] = []
    while len(hot) < DEPTH:
        found = [r["h"] for r in sizes(hot).where(F.col("n") > budget).select("h").toLocalIterator()]
        if not found:
            break
        hot.append(np.sort(np.array(found, np.int64).view(np.uint64)))
    bins = np.zeros(_BINS, np.int64)
    for r in sizes(hot, 64 - _BINS.bit_length() + 1).toLocalIterator():
        bins[r["h"]] = r["n"]
    borders, held = [], 0
    for k, n in enumerate(bins.tolist()):
        if held and held + n > budget:
            borders.append(k)
            held = 0
        held += n
    return hot, np.array(borders, np.uint64)


def _emit_groups(hot, borders):
    """Chunks cut by group, each part with the ids it needs."""
    def run(batches):
        for batch in batches:
            for lang, paths, counts, ids in _read(batch):
                h, length = prefixes(lang, paths, ids, hot)
                group = np.searchsorted(borders, h >> np.uint64(64 - _BINS.bit_length() + 1), side="right")
                order = np.argsort(group, kind="stable")
                ends = np.flatnonzero(np.diff(group[order])) + 1
                for part in np.split(order, ends):
                    codes = np.stack([(paths[part] >> np.uint64(16 * (DEPTH - 1 - k))) & np.uint64(0xFFFF)
                                      for k in range(DEPTH)])
                    used, local = np.unique(codes, return_inverse=True)
                    local = local.reshape(codes.shape).astype(np.uint16)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang], pa.string()), pa.array([int(group[part[0]])], pa.int32()),
                         pa.array([local.tobytes()], pa.binary()),
                         pa.array([counts[part].tobytes()], pa.binary()),
                         pa.array([length[part].astype(np.uint8).tobytes()], pa.binary()),
                         pa.array([ids[used.astype(np.int64)].tobytes()], pa.binary())],
                        names=["lang", "grp", "codes", "counts", "lengths", "ids"])
    return run


def count_nodes(columns: list[np.ndarray], counts: np.ndarray, lengths: np.ndarray, min_count: int):
    """(depth, rows, totals) of the nodes of two words or more of a subtree that reach
    ``min_count`` or have leaves elsewhere. ``columns`` hold the words of each path as
    numbers (0: ended); ``rows`` point to a path below each node."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    starts = []
    for c in columns:  # where the first 1, 2, ... words differ from the path before
        fresh = fresh | np.concatenate(([True], c[1:] != c[:-1]))
        starts.append(np.flatnonzero(fresh))
    leaves = starts[-1]
    totals = np.add.reduceat(counts[order], leaves)
    longest = np.maximum.reduceat(lengths[order], leaves)
    for depth in range(2, DEPTH + 1):
        first = np.searchsorted(leaves, starts[depth - 1])
        total = np.add.reduceat(totals, first)
        partly = np.maximum.reduceat(longest, first) > depth
        keep = (columns[depth - 1][leaves[first]] != 0) & ((total >= min_count) | partly)
        yield depth, order[leaves[first[keep]]], total[keep]


def _count_group(min_count: int):
    def run(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        ids = [np.frombuffer(b, np.int64) for b in pdf["ids"]]
        known = np.unique(np.concatenate([np.zeros(1, np.int64), *ids]))
        zero = int(np.searchsorted(known, 0))
        rank = np.arange(len(known), dtype=np.int32)
        rank[:zero + 1] = (rank[:zero + 1] + 1) % (zero + 1)  # 0, the end, first
        columns = [[] for _ in range(DEPTH)]
        for own, codes in zip(ids, pdf["codes"]):
            at = rank[np.searchsorted(known, own)]
            local = np.frombuffer(codes, np.uint16).reshape(DEPTH, -1)
            for k in range(DEPTH):
                columns[k].append(at[local[k]])
        columns = [np.concatenate(c) for c in columns]
        counts = np.concatenate([np.frombuffer(b, np.uint32) for b in pdf["counts"]]).astype(np.int64)
        lengths = np.concatenate([np.frombuffer(b, np.uint8) for b in pdf["lengths"]])
        back = np.empty(len(known), np.int64)
        back[rank] = known
        found, totals = [], []
        for depth, rows, total in count_nodes(columns, counts, lengths, min_count):
            found += np.stack([back[columns[k][rows]] for k in range(depth)], axis=1).tolist() if len(rows) else []
            totals.append(total)
        return pd.DataFrame({"lang": key[0], "path": pd.Series(found, dtype=object), "f": np.concatenate(totals)})
    return run


def subtree_counts(chunks: DataFrame, min_count: int, budget: int = BUDGET) -> DataFrame:
    """(lang, path, f) of the phrases of two words or more with ``min_count`` occurrences."""
    hot, borders = partition(chunks, budget)
    parts = chunks.mapInArrow(_emit_groups(hot, borders), "lang string, grp int, codes binary, counts binary, "
                                                          "lengths binary, ids binary")
    nodes = parts.groupBy("lang", "grp").applyInPandas(_count_group(min_count), "lang string, path array<bigint>, f long")
    return nodes.groupBy("lang", "path").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


@contextmanager
def _small_batches(spark):
    """Rows of chunks are large: Spark's 64 MB of them in an Arrow batch, twice in a
    buffer that grows, is most of a small executor's memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, budget: int = BUDGET, bits: int = FILTER_BITS,
                  chunk: int = CHUNK, digest=xxhash.xxh64_intdigest) -> tuple[DataFrame, DataFrame]:
    """(lang, path, f) of all phrases of up to DEPTH words with ``min_count``
    occurrences, as lists of word ids; and the ``vocabulary``."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
                       docs["text"].cast("string").alias("text"))
    with _small_batches(docs.sparkSession):
        words, taboo = vocabulary(rows, min_count, digest)
        chunks = suffix_chunks(rows, words, taboo, bits, chunk, digest)
        for k in range(2, DEPTH):
            chunks = pruned(chunks, k, min_count, bits, chunk)
        single = words.where("id <> 0").select("lang", F.array("id").alias("path"), "f")
        return materialize(single.union(subtree_counts(chunks, min_count, budget)), "collocation-counts"), words


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, path, a, l, r, score) of every candidate, at its lowest-scoring cut."""
    cut = F.explode(F.sequence(F.lit(1), F.size("path") - 1)).alias("k")
    cuts = counts.where(F.size("path") > 1).select("lang", "path", F.col("f").alias("a"), cut).select(
        "*", F.slice("path", F.lit(1), F.col("k")).alias("first"),
        F.slice("path", F.col("k") + 1, F.size("path") - F.col("k")).alias("rest"))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("path").alias(part), F.col("f").alias(name)), ["lang", part])
    # Decimals, as 2000000 a passes 64 bits beyond 10^12.
    score = F.expr("CAST((CAST(2000000 AS decimal(7,0)) * CAST(a AS decimal(19,0))) div "
                   "(CAST(l AS decimal(19,0)) + CAST(r AS decimal(19,0))) AS bigint)")
    return (cuts.withColumn("score", score).groupBy("lang", "path")
            .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best"))
            .select("lang", "path", "best.a", "best.l", "best.r", "best.score"))


def covered(counts: DataFrame) -> DataFrame:
    """(lang, path, longest): the greatest count of a longer candidate around each path."""
    def inside(path):
        n = F.size(path)
        parts = F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(
            F.sequence(F.lit(1), n - m + 1), lambda i: F.slice(path, i, m)))
        return F.explode(F.array_distinct(F.flatten(parts)))
    return (counts.where(F.size("path") > 2).select("lang", inside(F.col("path")).alias("path"), "f")
            .groupBy("lang", "path").agg(F.max("f").alias("longest")))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, cover: int = COVER, top: int = TOP,
                 **limits) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    counts, words = phrase_counts(docs, min_count, **limits)
    rows = scored(counts).join(covered(counts), ["lang", "path"], "left")
    inside = F.lit(100).cast("decimal(3,0)") * _exact("longest") >= F.lit(cover).cast("decimal(3,0)") * _exact("a")
    rows = rows.where(~F.coalesce(inside, F.lit(False))).drop("longest")
    # Phrases are spelt out for those only that may be among the first.
    order = [F.desc("score"), F.desc("a")]
    rows = rows.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top)
    rows = materialize(rows.drop("place"), "collocation-best")
    letters = rows.select("lang", "path", F.posexplode("path").alias("at", "id")).join(
        words.select("lang", "id", "word"), ["lang", "id"])
    spelt = letters.groupBy("lang", "path").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    totals = words.where("id = 0").select("lang", F.col("f").alias("n"))
    rows = rows.join(spelt, ["lang", "path"]).join(totals, "lang")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order, F.asc("phrase")))
    return (rows.withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


ORACLE = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS s FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(s, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(ws[i:i+k-1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM w, (VALUES (1), (2), (3), (4)) AS v(k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
c AS (SELECT lang, phrase, f AS a, cut, string_split(phrase, ' ') AS ws
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1)),
s AS (
  SELECT c.lang, c.phrase, a, l.f AS l, r.f AS r, cut, (2000000::HUGEINT * a // (l.f + r.f))::BIGINT AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[cut+1:], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
  SELECT lang, f, array_to_string(ws[i:i+m-1], ' ') AS phrase
  FROM (SELECT lang, f, ws, m, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT *, string_split(phrase, ' ') AS ws FROM f), (VALUES (2), (3)) AS v(m) WHERE m < k)),
most AS (SELECT lang, phrase, max(f) AS f FROM around GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM best JOIN n USING (lang) LEFT JOIN most USING (lang, phrase)
WHERE most.f IS NULL OR 100::HUGEINT * most.f < {COVER}::HUGEINT * a
QUALIFY rank <= {TOP}
"""
