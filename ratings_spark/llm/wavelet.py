"""Token ids in wavelet matrices, one file row a shard.

Documents are range-sorted by doc_id; each range partition is tokenised and
written as shards of about ``SHARD_TOKENS`` ids. A shard is a wavelet matrix:
one bit plane for each bit of an id, highest first; after each plane ids with a
0 go before ids with a 1, in order. With running counts of ones every 512 bits
(rank), the file answers ``access`` (the id at a place), ``count`` (occurrences of
an id in a range) and ``locate`` (their places) without being unpacked, and
``decode`` unpacks it whole.

File format (little-endian), stored as the binary column ``payload`` of a Parquet
table, so that any store Spark reaches can hold it, with the shard's number,
documents and ids beside it:

    4 bytes  magic "WVM1"
    uint32   number of planes
    uint64   number of ids n
    uint64   number of documents d
    uint64   d+1 document borders (ids before each, then n)
    planes   each: uint64 zeros in the plane, ceil(n / 64) uint64 words

Defined results: null text is an empty text, with only the end id; rows are one
for one with the input; rows sort by (doc_id, text), null ids first, so ties have
a place of their own and equal rows are interchangeable. An empty table gives
no shards and no rows.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from ..session import materialize, ship_package
from .common import text_of

VOCABULARY, END = "word_bpe_49k.json", 1
SHARD_TOKENS = 1 << 20
_MAGIC = b"WVM1"
_BLOCK = 512  # bits between running counts


# --- the matrix ---------------------------------------------------------------

def encode(ids: np.ndarray, borders: np.ndarray) -> bytes:
    """The file of ``ids`` (unsigned) with the documents' ``borders``."""
    ids = np.ascontiguousarray(ids)
    n, planes = len(ids), max(1, int(ids.max()).bit_length() if len(ids) else 1)
    out = [_MAGIC, struct.pack("<IQQ", planes, n, len(borders) - 1), np.asarray(borders, "<u8").tobytes()]
    ids = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    for level in range(planes - 1, -1, -1):
        ones = (ids & ids.dtype.type(1 << level)) != 0
        packed = np.packbits(ones, bitorder="little")
        zeros = ids[~ones]
        ids = np.concatenate([zeros, ids[ones]])
        out += [struct.pack("<Q", len(zeros)), packed.tobytes(), bytes(-len(packed) % 8)]
    return b"".join(out)


class WaveletMatrix:
    """Queries on an encoded shard."""

    def __init__(self, payload: bytes):
        if payload[:4] != _MAGIC:
            raise ValueError("not a wavelet matrix file")
        planes, self.n, docs = struct.unpack_from("<IQQ", payload, 4)
        at = 24
        self.borders = np.frombuffer(payload, "<u8", docs + 1, at).astype(np.int64)
        at += 8 * (docs + 1)
        width = (self.n + 63) // 64 * 8
        self.zeros, self.planes = [], []
        for _ in range(planes):
            self.zeros.append(struct.unpack_from("<Q", payload, at)[0])
            self.planes.append(np.frombuffer(payload, np.uint8, width, at + 8))
            at += 8 + width
        self._counts: list = [None] * planes

    def _ones_before(self, level: int, places: np.ndarray) -> np.ndarray:
        """Rank: ones of the plane before each place."""
        plane = self.planes[level]
        if self._counts[level] is None:
            bytes_ = _BLOCK // 8
            padded = np.concatenate([plane, np.zeros(-len(plane) % bytes_ + bytes_, np.uint8)])
            per = np.bitwise_count(padded).reshape(-1, bytes_).sum(axis=1, dtype=np.int64)
            self._counts[level] = (np.concatenate([[0], np.cumsum(per)]), padded)
        counts, padded = self._counts[level]
        places = np.asarray(places, np.int64)
        block = places // _BLOCK
        window = padded.reshape(-1, _BLOCK // 8)[block]
        inside = places - block * _BLOCK
        keep = np.clip(inside[:, None] - np.arange(0, _BLOCK, 8), 0, 8)
        part = np.bitwise_count(window & ((1 << keep) - 1).astype(np.uint8)).sum(axis=1, dtype=np.int64)
        return counts[block] + part

    def _bits(self, level: int, places: np.ndarray) -> np.ndarray:
        return (self.planes[level][places >> 3] >> (places & 7).astype(np.uint8)) & 1

    def access(self, places) -> np.ndarray:
        """The ids at ``places``."""
        places = np.atleast_1d(np.asarray(places, np.int64))
        ids = np.zeros(len(places), np.uint32)
        for level in range(len(self.planes)):
            bit = self._bits(level, places)
            ones = self._ones_before(level, places)
            places = np.where(bit == 1, self.zeros[level] + ones, places - ones)
            ids = ids << np.uint32(1) | bit
        return ids

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where occurrences of ``token`` in [low, high) stand below the last plane."""
        planes = len(self.planes)
        if token >> planes:
            return 0, 0
        for level in range(planes):
            a, b = self._ones_before(level, np.array([low, high])).tolist()
            if token >> (planes - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of ``token`` in [low, high)."""
        a, b = self._range(token, low, self.n if high is None else high)
        return b - a

    def locate(self, token: int, low: int = 0, high: int | None = None) -> np.ndarray:
        """Places of the occurrences, ascending: select, plane by plane upwards."""
        a, b = self._range(token, low, self.n if high is None else high)
        places, planes = np.arange(a, b), len(self.planes)
        for level in range(planes - 1, -1, -1):
            one = token >> (planes - 1 - level) & 1
            places = self._select(level, one, places - (self.zeros[level] if one else 0))
        return places

    def _select(self, level: int, one: int, ranks: np.ndarray) -> np.ndarray:
        """Places of the given ones (or zeros) of a plane: a search of the
        running counts."""
        low, high = np.zeros(len(ranks), np.int64), np.full(len(ranks), self.n, np.int64)
        for _ in range(max(1, self.n).bit_length() + 1):
            mid = (low + high) >> 1
            ones = self._ones_before(level, np.minimum(mid + 1, self.n))
            reached = (ones if one else np.minimum(mid + 1, self.n) - ones) > ranks
            low, high = np.where(reached, low, mid + 1), np.where(reached, mid, high)
            low = np.minimum(low, high)
        return low

    def decode(self) -> np.ndarray:
        """All ids in order: the planes undone from the lowest up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            above = np.empty_like(ids)
            above[~ones] = ids[:self.zeros[level]]
            above[ones] = ids[self.zeros[level]:] | kind(1 << (len(self.planes) - 1 - level))
            ids = above
        return ids


# --- tokens ---------------------------------------------------------------------

# Characters whose class and lower case no Unicode version changes: printable
# ASCII and the letters of Latin-1. Words of these only are split and merged
# here; others go through the library.
_PLAIN = [chr(c) for c in (*range(0x21, 0x7F), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
_MEMO = 800_000


class _Words(dict):
    """Ids of a word (characters between spaces) as little-endian uint32 bytes;
    the first _MEMO words are kept, which the frequent ones are among.

    A vocabulary with word ends is a byte-pair vocabulary over bytes and one
    more symbol that ends a word: 0xFF, which no UTF-8 text holds. Merged first
    with the byte before it, it makes the word-end form of that byte."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        with open(public_tokenizers.path(vocabulary), encoding="utf-8") as f:
            config = json.load(f)
        # A word that may hold an added token (all begin alike) is left to the library.
        added = {t["content"][0] for t in config["added_tokens"]}
        self.plain = "".join(c for c in _PLAIN if c not in added)
        model = config["model"]
        end = model["end_of_word_suffix"]
        letters = _byte_letters()
        order = [bytes([b]) + b"\xff" for b in range(256)]  # ranks: these first, then the merges
        names = [c + end for c in letters]
        back = {c: bytes([b]) for b, c in enumerate(letters)}
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            name = left + right
            body = name.removesuffix(end)
            order.append(b"".join(map(back.__getitem__, body)) + b"\xff" * (body != name))
            names.append(name)
        order += [bytes([b]) for b in range(256)]
        names += letters
        merger = tiktoken.Encoding("words", pat_str=".", special_tokens={},
                                   mergeable_ranks={w: k for k, w in enumerate(order)})
        self.merge = merger._core_bpe.encode_single_piece
        self.ids = [struct.pack("<I", model["vocab"][n]) for n in names]

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():  # one part
            ids = b"".join(map(self.ids.__getitem__, self.merge(word.lower().encode() + b"\xff")))
        elif not word.strip(self.plain):  # nothing else in it
            merge, ids = self.merge, self.ids
            ids = b"".join([ids[r] for part in _SPLIT.findall(word.lower())
                            for r in merge(part.encode() + b"\xff")])
        else:
            ids = np.array(self.library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < _MEMO and len(word) <= 64:
            self[word] = ids
        return ids


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself where printable, else the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


_WORDS: dict[str, _Words] = {}


def tokenise(text: str, vocabulary: str = VOCABULARY) -> bytes:
    """Ids of a text as the tokenizers library gives them, as little-endian
    uint32. This kind of vocabulary (byte pairs with word ends) drops white
    space and no token spans it, so they are those of its words."""
    if vocabulary not in _WORDS:
        _WORDS[vocabulary] = _Words(vocabulary)
    return b"".join(map(_WORDS[vocabulary].__getitem__, text.replace("\n", " ").split(" ")))


# --- shards ---------------------------------------------------------------------

def _write_shards(vocabulary: str, end: int, shard_tokens: int):
    """Columns doc_id, text in order. One row a shard."""
    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        docs, chunks, borders = [], [], [0]
        kind, last = None, struct.pack("<I", end)

        def shard():
            ids = np.frombuffer(b"".join(chunks), "<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                 pa.array([docs], pa.list_(kind)), pa.array([len(ids)], pa.int64()),
                 pa.array([encode(ids, np.array(borders))], pa.binary())],
                names=["part", "shard", "docs", "n_tokens", "payload"])

        for batch in batches:
            kind = batch.column(0).type
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    ids = tokenise(text, vocabulary) + last
                    docs.append(doc)
                    chunks.append(ids)
                    borders.append(borders[-1] + len(ids) // 4)
                    if borders[-1] >= shard_tokens:
                        yield shard()
                        number, docs, chunks, borders = number + 1, [], [], [0]
        if docs:
            yield shard()
    return run


def write(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END,
          shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The shards of all documents, written below the shared folder and read
    back: part, shard (in that order), docs, n_tokens, payload."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ordered = (docs.select("doc_id", text_of(docs).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    shards = ordered.mapInArrow(
        _write_shards(vocabulary, end, shard_tokens),
        f"part int, shard int, docs array<{kind}>, n_tokens bigint, payload binary")
    return materialize(shards, "wavelet")


def _read_shards(batches):
    """Columns before, docs, payload. One row a document."""
    for batch in batches:
        kind = batch.column(1).type.value_type
        for k in range(batch.num_rows):
            matrix = WaveletMatrix(batch.column(2)[k].as_buffer().to_pybytes())
            ids = matrix.decode().astype("<u4")
            borders = matrix.borders
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column(1)[k].as_py(), kind), pa.array(borders[:-1] + batch.column(0)[k].as_py()),
                 pa.array(np.diff(borders)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the shards.
    Shards are numbered within range partitions; ids before a shard are summed
    over partitions, then within its own."""
    ship_package(shards.sparkSession)
    whole = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    whole = whole.withColumn("base", F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    heads = shards.select("part", "shard", "n_tokens").withColumn("inside", F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)))
    before = (heads.join(whole, "part")
              .select("part", "shard", (F.coalesce("base", F.lit(0)) + F.coalesce("inside", F.lit(0))).alias("before")))
    before = materialize(before, "wavelet-starts")
    kind = shards.schema["docs"].dataType.elementType.simpleString()
    return (shards.join(before, ["part", "shard"]).select("before", "docs", "payload")
            .mapInArrow(_read_shards, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"))


def round_trip(docs: DataFrame, **settings) -> DataFrame:
    """Writes all documents and reads them back."""
    return read(write(docs, **settings))
