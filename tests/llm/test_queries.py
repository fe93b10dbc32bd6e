"""The registered queries against their SQL, and the pipeline against brute force."""

import helpers as H
import pytest

import corpus_pipeline
from ratings_spark.llm import classifier, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    got = queries.QUERIES[name](spark, H.SF)
    want = H.duck().execute(queries.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert H.rows_of(got, *names) == sorted(want.fetchall(), key=key)


def test_every_operator_has_its_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)] + ["pipeline"]


def _brute(docs, labels):
    """doc_ids after each filtering stage, by plain loops."""
    from test_simhash import find_roots, plain
    good = {r["doc_id"] for r in classifier.quality(docs, labels).where("predicted = 1").collect()}
    rows = {i: t for i, t in H.texts(docs) if i in good}
    last = {}
    for i in sorted(rows):
        last[rows[i]] = i
    rows = {i: rows[i] for i in last.values()}
    prints = {i: plain(t) for i, t in rows.items()}
    roots, one = find_roots(list(prints.values())), {}
    for i in sorted(rows):
        one[roots[prints[i]]] = i
    return good, set(last.values()), set(one.values())


def test_pipeline_stages(spark):
    docs, labels = (spark.read.parquet(f"{H.SF}/{t}.parquet") for t in ("documents", "labels"))
    want, now = _brute(docs, labels), docs
    for (_, stage), ids in zip(corpus_pipeline.STAGES[:3], want):
        now = stage(spark, now, H.SF).cache()
        assert now.columns == docs.columns
        assert sorted(r[0] for r in now.select("doc_id").collect()) == sorted(ids)
    assert now.exceptAll(docs).count() == 0
    mixed = corpus_pipeline.STAGES[3][1](spark, now, H.SF).cache()
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == docs.columns and set(counts) <= want[2] and max(counts.values()) <= 3
    packed = corpus_pipeline.STAGES[4][1](spark, mixed, H.SF)
    pieces = {r["doc_id"]: r["count"] for r in packed.where("piece = 0").groupBy("doc_id").count().collect()}
    assert pieces == counts


def test_pipeline_runs_on_odd_and_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for name, docs in (("odd", H.odd(spark, "size", "fp", "doc", "x")), ("empty", H.nothing(spark))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        none.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert out.count() >= 0
        assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
