import random

import helpers as H
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import example, given, settings
from hypothesis import strategies as st

from ratings_spark.llm import token_counts as T

SP = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(T.MODEL))
KEY = lambda r: tuple((x is not None, str(type(x)), x) for x in r)


def count(text):
    m = T.machine()
    text = " " + text.replace("▁", " ") if text else ""
    return m.count(text)


@settings(max_examples=400, deadline=None)
@example("a  b   c \n\n  d ")
@example("<s> </s> <0x0A> ▁▁▁ a▁b")
@example("\u0000\U0001f600   中文 ퟿")
@given(st.text(max_size=60))
def test_any_text(text):
    assert count(text) == len(SP.encode(text))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aeinorst   \nTH", max_size=80))
def test_mergeable_text(text):
    assert count(text) == len(SP.encode(text))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aeinrt  \n▁é", max_size=60), st.integers(1, 9), st.integers(1, 4), st.randoms())
def test_chunk_maps_compose_in_any_order(text, chunk, _, random):
    m = T.machine()
    full = " " + text.replace("▁", " ") if text else ""
    maps = [m.chunk(full[k:k + chunk]) for k in range(0, max(1, len(full)), chunk)]
    while len(maps) > 1:
        k = random.randrange(len(maps) - 1)
        maps[k:k + 2] = [m.compose(maps[k], maps[k + 1])]
    assert m.total(maps[0]) == len(SP.encode(text))


@pytest.mark.parametrize("chunk, fan", [(T.CHUNK, T.FAN), (7, 3)])
def test_documents(spark, chunk, fan):
    docs = H.documents(spark).cache()
    want = sorted(((i, len(t.encode()), n := len(SP.encode(t)), n > 4096) for i, t in H.texts(docs)), key=KEY)
    assert H.rows_of(T.token_counts(docs, chunk=chunk, fan=fan)) == want


def test_states_are_bounded(monkeypatch):
    monkeypatch.setattr(T, "_STATES", 200)
    letters = random.Random(1).choices("abcdefgh etnis", k=20000)
    text = "".join(letters)
    m = T.Transducer(T.machine().pieces)
    assert m.count(" " + text) == len(SP.encode(text)) and len(m.states) <= 202


def test_long_text_without_spaces():
    text = "abcdefghij" * 20000
    assert count(text) == len(SP.encode(text))


def test_empty_and_clashing_columns(spark):
    assert T.token_counts(H.nothing(spark)).collect() == []
    assert T.token_counts(H.odd(spark, "id", "head", "place", "n_tokens")).count() == len(H.ODD)
