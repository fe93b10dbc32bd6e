"""Named queries over the driver tables, each with an equivalent SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the library on whole
tables (via ``sources.adapters``); ``ORACLE[name]`` is the same computation
as plain SQL over the raw tables (DuckDB dialect), written independently.
Outputs are flat (lists exploded with their rank), doubles are rounded to
6 places, and column names/types agree between the two forms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --- SQL fragments: the adapters, restated in SQL -----------------------------
RATINGS_SQL = """
  SELECT o.o_custkey AS uid, l.l_partkey AS mid,
         CAST(ceil(l.l_quantity / 5) / 2 AS DOUBLE) AS score,
         CAST(floor(epoch(o.o_orderdate)) AS BIGINT) AS timestamp,
         l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity, l.l_extendedprice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

TAGS_SQL = """
  SELECT o.o_custkey AS uid, l.l_partkey AS mid, o.o_orderpriority AS tag,
         CAST(floor(epoch(o.o_orderdate)) AS BIGINT) AS timestamp
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

MOVIES_SQL = """
  SELECT p_partkey AS mid, p_name AS name, '' AS descri,
         CAST(p_size AS VARCHAR) || ' minutes' AS timelong, '' AS issue,
         CAST(p_size + 1970 AS VARCHAR) AS shoot, p_brand AS language,
         concat_ws('|', p_type, replace(p_name, ' ', '|')) AS genres,
         p_brand AS actors, '' AS directors
  FROM part"""

MESSAGES_SQL = """
  SELECT user_id AS uid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS mid,
         CAST(least(10, 1 + floor(value / 10)) / 2 AS DOUBLE) AS score,
         CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, event_id AS msg_id
  FROM events"""

FACTORS_SQL = """
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings"""

RATING_ORDER_SQL = ("timestamp DESC, l_orderkey, l_linenumber, mid, l_suppkey, "
                    "l_quantity, l_extendedprice")
MESSAGE_ORDER_SQL = "timestamp DESC, msg_id DESC"


def with_(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n"


# Genre list used on the part-derived catalogue: two part types' words, one
# mixed-case word, and a name that matches nothing.
FIXTURE_GENRES = ["PROMO", "ring", "Large", "Ccrime"]
