import struct
import zlib

import helpers as H
import numpy as np
import public_tokenizers
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ratings_spark.llm import wavelet as W

TOK = Tokenizer.from_file(public_tokenizers.path(W.VOCABULARY))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70000), max_size=700), st.integers(0, 70000))
def test_matrix_answers_as_a_list(ids, token):
    ids = np.array(ids, np.uint32)
    m = W.WaveletMatrix(W.encode(ids, np.array([0, len(ids)])))
    assert m.decode().tolist() == ids.tolist()
    if len(ids):
        assert m.access(np.arange(len(ids))).tolist() == ids.tolist()
    for t in {token, *ids[:3].tolist()}:
        assert m.count(t) == int((ids == t).sum())
        assert m.locate(t).tolist() == np.flatnonzero(ids == t).tolist()
        low, high = len(ids) // 3, len(ids) - len(ids) // 4
        assert m.count(t, low, high) == int((ids[low:high] == t).sum())
        assert m.locate(t, low, high).tolist() == (np.flatnonzero(ids[low:high] == t) + low).tolist()


def test_large_matrix():
    ids = np.random.default_rng(0).integers(0, 40, 200_000).astype(np.uint32)
    m = W.WaveletMatrix(W.encode(ids, np.array([0, len(ids)])))
    places = np.random.default_rng(1).integers(0, len(ids), 1000)
    assert (m.access(places) == ids[places]).all() and (m.locate(7) == np.flatnonzero(ids == 7)).all()
    assert len(W.encode(ids, np.array([0, len(ids)]))) < len(ids)  # 6 bits an id


@settings(max_examples=200, deadline=None)
@example("don't\u001cit's  I'LL<|endoftext|>x <|startoftext|> é Σας\tΣ ")
@given(st.text(max_size=50))
def test_words_give_the_ids_of_the_text(text):
    assert np.frombuffer(W.tokenise(text), "<u4").tolist() == TOK.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdeorstTHEÀéßÿ×÷µº'<|>9.,!~ \n", max_size=60))
def test_plain_words_are_merged_as_by_the_library(text):
    assert np.frombuffer(W.tokenise(text), "<u4").tolist() == TOK.encode(text, add_special_tokens=False).ids


def test_every_entry_of_the_vocabulary_as_a_word():
    back = {c: b for b, c in enumerate(W._byte_letters())}
    for token in TOK.get_vocab():
        raw = bytes(back.get(c, 32) for c in token.removesuffix("</w>"))
        word = raw.decode("utf-8", "ignore")
        assert np.frombuffer(W.tokenise(word), "<u4").tolist() == TOK.encode(word, add_special_tokens=False).ids


def test_round_trip(spark):
    docs = H.documents(spark).cache()
    order = sorted(H.texts(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want, at = [], 0
    for i, t in order:
        ids = TOK.encode(t, add_special_tokens=False).ids + [1]
        want.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    key = lambda r: tuple((x is not None, x) for x in r)
    for tokens in (W.SHARD_TOKENS, 1000):
        assert H.rows_of(W.round_trip(docs, shard_tokens=tokens)) == sorted(want, key=key)


def test_empty_and_clashing_columns(spark):
    assert W.round_trip(H.nothing(spark)).collect() == []
    assert W.round_trip(H.odd(spark, "part", "shard", "payload", "docs")).count() == len(H.ODD)
