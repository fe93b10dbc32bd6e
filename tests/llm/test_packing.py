import struct
import zlib
from collections import defaultdict

import helpers as H
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ratings_spark.llm import packing as P


def expected_pieces(pairs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, t in pairs:
        ids = tok.encode(t, add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)]
        for k, a in enumerate(starts):
            part = ids[a:first] if k == 0 else ids[a:a + 1024]
            out.append((i, k, a, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return sorted(out, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


def check(rows, sequence=1024):
    """Every sequence is filled without gaps or overlaps."""
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= sequence
    return len(bins)


def best_fit(lengths, sequence=1024):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            g = min(fits)
            gaps.remove(g)
            gaps.append(g - n)
        else:
            gaps.append(sequence - n)
    return len(gaps)


def test_pieces_and_packing(spark):
    docs = H.documents(spark).cache()
    got = P.pack_documents(docs).cache()
    assert H.rows_of(got, "doc_id", "piece", "start", "length", "ids_crc32") == expected_pieces(H.texts(docs))
    rows = got.collect()
    assert check(rows) <= best_fit([r["length"] for r in rows])


def test_tokenizers_alone_gives_the_same(spark):
    docs = H.odd(spark, "rank", "part", "sequence_id", "length")
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert H.rows_of(P.pieces(docs, ranks=None), *columns) == H.rows_of(P.pieces(docs), *columns)
    check(P.pack_documents(docs, sequence=64).collect(), 64)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_sweep_is_best_fit_decreasing(counts):
    plan = P.sweep(counts, 64)
    lengths = [n for n, k in counts.items() for _ in range(k)]
    placed = defaultdict(list)
    for n, k in counts.items():
        mine = [p for p in plan if p[0] == n]
        for r in range(k):
            row = [p for p in mine if p[1] <= r][-1]
            step = r - row[1]
            placed[row[3] + step // row[2]].append((row[4] + step % row[2] * n, n))
    used = 0
    for parts in placed.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
        used += 1
    assert used == best_fit(lengths, 64)


def test_empty(spark):
    assert P.pack_documents(H.nothing(spark)).collect() == []


def test_both_libraries_split_at_every_character_alike():
    fast, library = P.encoder(), P.encoder(ranks=None)
    for low in range(0, 0x20000, 4096):
        chars = [chr(c) for c in range(low, low + 4096) if not 0xD800 <= c < 0xE000]
        texts = [f"a{c}1 {c}b{c}{c}. {c}\n" for c in chars]
        assert fast(texts) == library(texts)


def test_long_runs_without_spaces():
    for text in ("ab" * 50_000, "a" * 100_000, " " * 100_000, "\n" * 50_000, "é!" * 30_000):
        assert P.encoder()([text]) == P.encoder(ranks=None)([text])
    assert sum(map(len, P.encoder()([" " * 1_500_000 + "a", "\n \t" * 500_000]))) > 0
