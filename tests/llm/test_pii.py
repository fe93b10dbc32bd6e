import hashlib
import re

import helpers as H
import pytest
from pyspark.sql import functions as F

from ratings_spark.llm import pii as P

SHAPES = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    found = [(k, m.start(), m.end()) for k, shape in SHAPES for m in shape.finditer(text) if good(k, m[0])]
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
    return (*[sum(f[0] == k for f in found) for k, _ in SHAPES], hashlib.sha256(joined.encode()).hexdigest(), joined)


CASES = [
    "a@b.c_d@e.f x@y.z.w..q a@@b.c .@-.- a@b", "a@b.c@d.e é\U0001f600 mail x.y+z@mail.example.com.",
    "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.2.3 1.2.3 01.2.3.4", "4111111111111111 4111 1111 1111 1111 4111-1111-1111-1112",
    "4111111111111111 4111111111111111 12345678901234567890123", "+1 (017) 555-7713 +12 +1234567 +12345678. ++1 234 567 8901x",
    "1" * 3000 + " " + "1.2.3.4 " * 800, "a" * 20000 + "@", "1 " * 6000, "a@b" + ".c" * 8000, "+1" + "2-" * 3000,
    "5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 5", "", None,
]


def test_base_matches(spark):
    docs = H.documents(spark).select("doc_id", "text").union(
        spark.createDataFrame(list(enumerate(CASES, 5000)), "doc_id bigint, text string")).cache()
    got = P.personal_data(docs)
    want = sorted(((i, *base(t)[:5]) for i, t in H.texts(docs)),
                  key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))
    assert H.rows_of(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want
    spans = dict(H.rows_of(got.where("n_found = 0"), "doc_id", "spans"))
    assert all(spans[i] == base(t)[5] for i, t in H.texts(docs) if i is not None and i != 9 and i in spans)


def test_contexts_lead_to_unseen_identifiers(spark):
    rows = [(k, f"name tel: +1 555 010 {1000 + k} {'abcdef'[k % 6]}nd") for k in range(30)]
    rows += [(100, "please tel: 555/0199-22 end"), (101, "see tel: 555/0200-33 today"),
             (102, "page 1234 end of it"), (103, "the year 1984 was")]
    rows += [(200 + k, f"end {k}00{k}7 end") for k in range(9)]
    got = {r["doc_id"]: r for r in P.personal_data(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0]["spans"] == "phone:10:25" and got[0]["n_phone"] == 1
    assert got[100]["spans"] == "phone:12:23" and got[100]["n_found"] == 1 and got[100]["n_phone"] == 0
    assert got[101]["spans"] == "phone:9:20"
    assert got[102]["spans"] == "" and got[103]["spans"] == "" and got[200]["spans"] == ""


@pytest.mark.parametrize("unseen", [8, 15, 30])
def test_many_unseen_values_in_a_telling_context(spark, unseen):
    rows = [(k, f"name tel: +1 555 010 {1000 + k} {'abcdef'[k % 6]}nd") for k in range(30)]
    rows += [(100 + k, f"please tel: 555/{2000 + k}-22 {'qrstu'[k % 5]}end") for k in range(unseen)]
    rows += [(200 + k, f"page {3000 + k} {'abcdef'[k % 6]}nd of") for k in range(60)]
    rows += [(300 + k, f"code {k}x{k}@ zz") for k in range(10)]
    # Seeds stand here as often as anywhere: nothing is told.
    rows += [(400 + k, f"w{k} +1 555 777 {1000 + k} often") for k in range(5)]
    rows += [(500 + k, f"v{k} {5000 + k} often") for k in range(60)]
    got = {r["doc_id"]: r for r in P.personal_data(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[100 + k]["spans"] for k in range(unseen)] == ["phone:12:23"] * unseen
    assert {got[i]["n_found"] for i in got if i < 100 or i >= 200} == {0}


def test_values_of_other_kinds_speak_against_a_pattern(spark):
    rows = [(k, f"a{k} id: +1 555 010 {1000 + k} b{k}") for k in range(10)]
    rows += [(100 + k, f"c{k} id: m{k}@mail.example.com d{k}") for k in range(10)]
    rows += [(200 + k, f"e{k} id: {4000 + k} f{k}") for k in range(10)]
    got = P.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got.where("n_found > 0").count() == 0


def test_identifiers_of_several_words_are_found_whole(spark):
    long = "w" * 100
    rows = [(k, f"n{k} tel: +1 555 010 {1000 + k} a{k}x") for k in range(10)]
    rows += [(20 + k, f"n{k} mail: m{k}@mail.example.com b{k}x") for k in range(10)]
    rows += [(40 + k, f"n{k} card: 4111 1111 1111 1111 c{k}x") for k in range(3)]
    rows += [(50 + k, f"n{k} card: {c} c{k}x") for k, c in enumerate(("5500 0000 0000 0004", "4012-8888-8888-1881"))]
    rows += [(60 + k, f"n{k} {long}: +1 555 010 {2000 + k} d{k}x") for k in range(10)]
    unseen = {100: ("please tel: ", "020 7946 0958", " phone"), 101: ("see tel: ", "(020) 7946 / 0958", ", phone"),
              102: ("my tel:", "020 - 7946 - 0959", ". phone"), 103: ("old card: ", "4111 1111 1111 1112", " card"),
              104: ("ask mail: ", "jane at example dot com", " email"),
              105: ("ask mail: ", "jane dot doe99 [at] mail [dot] example [dot] org", " email"),
              106: (f"a {long}:" + " " * 70, "555/0199-22", " phone")}
    rows += [(i, a + b + c) for i, (a, b, c) in unseen.items()]
    rows += [(200, "meet joan at sample dot net"), (201, "in 1984 1985 1986 the"), (202, "x +1 555 010 9999 1234 y")]
    got = {r["doc_id"]: r["spans"] for r in P.personal_data(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, (before, value, after) in unseen.items():
        kind = after.strip(" ,.")
        assert got[i] == f"{kind}:{len(before)}:{len(before) + len(value)}", (i, got[i])
    assert got[200] == got[201] == "" and got[202].startswith("phone:2:")


def test_candidates_do_not_overlap_base_matches(spark):
    docs = H.documents(spark)
    rows = P.occurrences(docs).where("kind IS NOT NULL").collect()
    by = {}
    for r in rows:
        by.setdefault(r["rid"], []).append(r)
    for found in by.values():
        for c in found:
            if c["kind"] == "other":
                assert not any(b["kind"] != "other" and b["start"] < c["end"] and c["start"] < b["end"] for b in found)


@pytest.mark.parametrize("extra", [(), ("rid", "kind", "value", "left", "spans")])
def test_empty_and_clashing_columns(spark, extra):
    assert P.personal_data(H.nothing(spark)).collect() == []
    assert P.personal_data(H.odd(spark, *extra)).count() == len(H.ODD)


def test_patterns_take_linear_time(spark):
    """Long runs of what a pattern repeats, with an end that spoils the match."""
    import time
    parts = {"run": "12 " * 200_000 + "34kg", "written": "a dot " * 200_000 + "b", "email": "a." * 200_000 + "@",
             "ip": "1." * 200_000, "card": "1 " * 200_000 + "x", "phone": "+1 (" * 200_000, "other": "1@" * 200_000}
    assert set(parts) == set(P.PATTERNS)
    for name, text in parts.items():
        df = spark.createDataFrame([(text,)], "t string")
        begin = time.time()
        df.select(F.size(F.regexp_extract_all("t", F.lit(P.PATTERNS[name]), F.lit(0)))).collect()
        assert time.time() - begin < 5, name


def test_ends_of_runs_and_long_written_addresses(spark):
    def first(kind, text):
        got = spark.createDataFrame([(text,)], "t string").select(
            F.regexp_extract_all("t", F.lit(P.PATTERNS[kind]), F.lit(0))).first()[0]
        return got[0] if got else None
    assert first("run", "tel 12 34 56kg") == "12 34"
    assert first("run", "tel 12 34kg") is None
    assert first("written", "x a dot b dot c dot d dot e at x dot com y") == "a dot b dot c dot d dot e at x dot com"
