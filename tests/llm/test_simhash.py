from itertools import combinations

import helpers as H
import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ratings_spark.llm import simhash as S
from ratings_spark.llm.components import components


def plain(text, k=3):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def find_roots(values, distance=2):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(sorted(set(values)), 2):
        if (a ^ b).bit_count() <= distance:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {v: find(v) for v in values}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAB \t\nÉ\u001c ", max_size=60))
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) == plain(text)


def test_spark_xxhash64_is_the_same_hash(spark):
    got = spark.sql("select xxhash64('a b c')").first()[0] & (2**64 - 1)
    assert got == xxhash.xxh64_intdigest(b"a b c", 42) == S.fingerprint(b"a b c")


def test_equals_brute_force(spark):
    docs = H.documents(spark).cache()
    pairs = [(i, plain(t)) for i, t in H.texts(docs)]
    roots = find_roots([f for _, f in pairs])
    groups = {}
    for i, f in pairs:
        groups.setdefault(roots[f], []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    want = [(i, f"{f:016x}", least[roots[f]], len(groups[roots[f]])) for i, f in pairs]
    key = lambda r: tuple((x is not None, str(type(x)), x) for x in r)
    assert H.rows_of(S.near_duplicates(docs)) == sorted(want, key=key)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    best = sorted(max((i for i in ids if i is not None), default=-1) for ids in groups.values())
    assert sorted(-1 if r[0] is None else r[0] for r in kept.select("doc_id").collect()) == best


def test_links_connect_a_dense_ball(spark):
    rng = np.random.default_rng(3)
    values = {0}
    for _ in range(300):
        base = int(rng.choice([0, 2**63 + 5, 2**40]))
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            base ^= 1 << int(b)
        values.add(base)
    signed = [S._signed(v) for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for distance in (1, 2):
        want = find_roots(sorted(values), distance)
        got = {r["node"] & (2**64 - 1): r["root"] & (2**64 - 1)
               for r in components(S.links(fps, distance)).collect()}
        classes = lambda m: {frozenset(k for k in m if m[k] == r) for r in m.values()}
        assert {c for c in classes({v: got.get(v, v) for v in values})} == classes(want)


def test_components_of_a_long_chain(spark):
    links = spark.range(300).selectExpr("id as a", "id + 1 as b")
    rows = components(links).collect()
    assert len(rows) == 301 and {r["root"] for r in rows} == {0}


def test_empty_and_clashing_columns(spark):
    assert S.near_duplicates(H.nothing(spark)).collect() == []
    assert S.keep_one(H.nothing(spark)).collect() == []
    docs = H.odd(spark, "fp", "doc", "root", "fingerprint")
    assert S.keep_one(docs).columns == docs.columns


def test_parts_of_a_text_change_nothing(monkeypatch):
    texts = [" ".join(f"w{k % 7}x" for k in range(n)) for n in (0, 1, 2, 3, 50)] + ["  lead\t\ttail\n", "x" * 99]
    want = [plain(t) for t in texts]
    for size in (1, 5, 40):
        monkeypatch.setattr(S, "_SLICE", size)
        assert [S.fingerprint(t.encode()) for t in texts] == want
