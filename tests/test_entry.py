"""Driver contract, and every SQL oracle against its Spark query at sf0.001."""

import math

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from ratings_spark.plans import QUERIES

TABLES = ["part", "orders", "lineitem", "events", "embeddings"]
SLOW = {"als_grid"}
# The training-data queries have tests of their own, beside that part.
OTHER = set(E.queries()) - set(QUERIES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["genre", "rank", "mid", "avg"] and df.count() >= 0


def test_keys():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rs:
        out.append(tuple(round(r[i], 6) if isinstance(r[i], float) and not math.isnan(r[i])
                         else r[i] for i in order))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - SLOW - OTHER))
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(ocols, res.fetchall())
