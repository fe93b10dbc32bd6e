"""Merkle manifest of a dataset, by levels kept as strings.

Every row is a leaf. The leaves of a source, in order, form a tree of fan-out
``FAN``: runs of consecutive nodes are hashed into their parents until one is left,
the source's subroot; the subroots form the manifest's tree likewise.

Nodes are worked on in blocks of ``FAN ** HEIGHT`` that start at multiples of their
size, so a run never lies across two blocks. A block keeps each of its levels as one
string of hex digests: parents are hashes of fixed-width substrings, and what stands
left and right of a digest in its run are its siblings. A block ends in one digest,
and these are the nodes of the next round of blocks (``rise``), until each tree has
one; then the siblings found above are handed down block by block (``paths``). A
block's rows are bounded, so a source with most of all rows is many blocks, and a
round has some hundredth of the rows of the one before.

Defined results: null and empty values differ in a leaf (``-`` and ``0:``); a null
source is a source of its own, before all others; null ids come before others, rows
that repeat an id are ordered by their digests, and rows repeated whole are leaves of
their own. A row alone in its source is its subroot, without siblings there; no
siblings at all are hashed as the empty string. A null id is never tampered with. An
empty table has no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

FAN = 3
HEIGHT = 5  # levels in a block of 243 nodes: its lowest string has 15,552 digits
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(fields) -> Column:
    """Digest of a row's fields: ``-`` for null, else length in bytes, ``:``, value."""
    parts = []
    for f in fields:
        s = f.cast("string")
        parts.append(F.when(s.isNull(), "-").otherwise(
            F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return _hash(F.concat(*parts))


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, their place in their tree (from 0), and ``total``, the
    rows of it. Rows are range-sorted over all tasks and counted a task and tree;
    only these counts meet in a window."""
    keys = [tree, *order, "_copy"]  # equal rows are spread as well
    spread = (rows.withColumn("_copy", F.monotonically_increasing_id())
              .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_copy")
              .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")))
    spread = materialize(spread, "merkle-sorted")
    runs = spread.groupBy(tree, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(tree, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                       F.sum("_n").over(Window.partitionBy(tree)).alias("total"))
    return (spread.join(runs, [tree, "_part"])
            .withColumn("at", F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift"))


def _depth(total: Column) -> Column:
    """Levels above the nodes of a block: up to one node in a tree's only block,
    HEIGHT in each of several."""
    out = F.lit(HEIGHT)
    for d in reversed(range(HEIGHT)):
        out = F.when(total <= FAN ** d, d).otherwise(out)
    return out


def _parents(level: Column) -> Column:
    """The level above: hashes of the runs of a level."""
    width = FAN * DIGEST
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / width).cast("int"))
    return F.array_join(F.transform(runs, lambda k: _hash(F.substring(level, k * width + 1, F.lit(width)))), "")


def _levels(lowest: Column, depth: Column) -> Column:
    """All levels of a block, the lowest first."""
    steps = F.slice(F.array(*[F.lit(k) for k in range(HEIGHT)]), F.lit(1), depth)
    return F.aggregate(steps, F.array(lowest), lambda found, _: F.concat(
        found, F.array(_parents(F.element_at(found, -1)))))


def _siblings(levels: Column, k: Column) -> Column:
    """(left, right) in the run of the ``k``-th node, level by level."""
    def beside(level, height):
        at = F.floor(k / F.element_at(F.array(*[F.lit(FAN ** h) for h in range(HEIGHT + 1)]), height + 1))
        inside = (at % FAN).cast("int")
        begin = ((at - inside) * DIGEST + 1).cast("int")
        return F.struct(
            F.substring(level, begin, inside * DIGEST).alias("left"),
            F.substring(level, begin + (inside + 1) * DIGEST, (FAN - 1 - inside) * DIGEST).alias("right"))
    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), beside)


def rise(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of blocks from nodes (tree, at, total, digest, item) to one block a
    tree: (tree, block, total, nodes, levels), ``nodes`` in order as (at, item)."""
    size, rounds = FAN ** HEIGHT, []
    while True:
        blocks = (nodes.groupBy("tree", F.floor(F.col("at") / size).alias("block"))
                  .agg(F.first("total").alias("total"),
                       F.sort_array(F.collect_list(F.struct("at", "digest", "item"))).alias("nodes"))
                  .select("tree", "block", "total",
                          F.transform("nodes", lambda x: F.struct(x["at"], x["item"])).alias("nodes"),
                          _levels(F.array_join(F.transform("nodes", lambda x: x["digest"]), ""),
                                  _depth(F.col("total"))).alias("levels")))
        blocks = materialize(blocks, "merkle-blocks")
        rounds.append(blocks)
        if blocks.where(F.col("total") > size).isEmpty():
            return rounds
        nodes = blocks.select("tree", F.col("block").alias("at"), F.ceil(F.col("total") / size).alias("total"),
                              F.element_at("levels", -1).alias("digest"), F.lit(None).cast("int").alias("item"))


def roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, root) of the last round."""
    return rounds[-1].select("tree", F.element_at("levels", -1).alias("root"))


def paths(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(tree, item, path, carried) of each lowest node: the siblings on its way up,
    the lowest level first, then those ``above`` (tree, path, carried) gives its root."""
    out = above.withColumn("at", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        found = blocks.join(out.withColumnRenamed("at", "block"), ["tree", "block"])
        node = F.explode(F.transform("nodes", lambda x, k: F.struct(
            x["at"].alias("at"), x["item"].alias("item"),
            F.concat(_siblings(F.col("levels"), k), F.col("path")).alias("path")))).alias("node")
        out = found.select("tree", "carried", node).select("tree", "carried", "node.*")
    return out.drop("at")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda h, p: _hash(F.concat(p["left"], h, p["right"])))


def proof_digest(path: Column) -> Column:
    return _hash(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree (a string in the order of the sources, null first), the leaf's
    digest and that of the tampered row. Only digests go on from here."""
    fields = [docs[f] for f in FIELDS]
    stripped = F.regexp_replace(fields[-1], "\n", "")
    chosen = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0
    touched = F.coalesce(chosen & fields[-1].contains("\n"), F.lit(False))
    found = docs.select("doc_id", F.coalesce(F.concat(F.lit("="), docs["source"].cast("string")), F.lit("")).alias("tree"),
                        leaf(fields).alias("digest"),
                        F.when(touched, leaf([*fields[:-1], stripped])).alias("tampered"))
    return materialize(found.withColumn("tampered", F.coalesce("tampered", "digest")), "merkle-leaves")


def proofs(docs: DataFrame) -> DataFrame:
    """One row a row of ``docs``: doc_id, leaf, tampered (its digest after
    tampering), subroot, root and path, the siblings from leaf to root."""
    item = F.struct("doc_id", F.col("digest").alias("leaf"), "tampered").alias("item")
    low = rise(ranked(leaves(docs), "tree", ["doc_id", "digest", "tampered"])
               .select("tree", "at", "total", "digest", item))
    subroots = roots(low).select(F.lit("").alias("tree"), F.col("tree").alias("item"), F.col("root").alias("digest"))
    top = rise(ranked(subroots, "tree", ["item"]))
    crown = roots(top).select("tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"),
                              F.struct("root").alias("carried"))
    above = paths(top, crown).select(F.col("item").alias("tree"), "path", F.col("carried.root").alias("root"))
    above = above.join(roots(low).withColumnRenamed("root", "subroot"), "tree") \
        .select("tree", "path", F.struct("subroot", "root").alias("carried"))
    above = materialize(above, "merkle-sources")
    return paths(low, above).select("item.*", "carried.*", "path")


def manifest(docs: DataFrame) -> DataFrame:
    """``proofs`` as digests, and the check of each (tampered) row against the root."""
    rows = proofs(docs).select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                               fold(F.col("tampered"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = """list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''),
  lambda ch: list_prepend(unicode(ch)::BIGINT, list_transform(range(8), lambda z: -1::BIGINT)))),
  lambda c, e: CASE WHEN e >= 0 THEN xor(c, e)
    ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END) END, 4294967295::BIGINT)"""


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(
        f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')"
        for f in (*FIELDS[:-1], text)) + ")"


def _tree_sql(name: str, low: str) -> str:
    """Levels of every tree of ``low`` (tree, k, h, n): the run's number is k // 3."""
    return f"""{name} AS (
  SELECT tree, 0 AS height, k, h, n FROM {low}
  UNION ALL
  SELECT tree, height + 1, k // {FAN}, sha256(string_agg(h, '' ORDER BY k)), (n + {FAN - 1}) // {FAN}
  FROM {name} WHERE n > 1 GROUP BY tree, height, k // {FAN}, n)"""


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS rid, *,
    coalesce('=' || source, '') AS tree, {_leaf_sql('text')} AS leaf,
    CASE WHEN xor({_CRC}, 4294967295::BIGINT) % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS t
  FROM documents),
low AS (
  SELECT rid, doc_id, tree, leaf AS h, coalesce(t, leaf) AS tampered, count(*) OVER (PARTITION BY tree) AS n,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k FROM d),
{_tree_sql("lv", "low")},
sub AS (
  SELECT tree AS src, h, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS k, count(*) OVER () AS n
  FROM lv WHERE n = 1),
{_tree_sql("top", "sub")},
lr AS (SELECT tree, height, k // {FAN} AS run, list(struct_pack(k := k, h := h) ORDER BY k) AS hs
       FROM lv WHERE n > 1 GROUP BY ALL),
tr AS (SELECT height, k // {FAN} AS run, list(struct_pack(k := k, h := h) ORDER BY k) AS hs
       FROM top WHERE n > 1 GROUP BY ALL),
steps AS (
  SELECT rid, lr.height AS s, k // ({FAN} ** lr.height)::BIGINT AS own, hs
  FROM low JOIN lr ON lr.tree = low.tree AND lr.run = low.k // ({FAN} ** (lr.height + 1))::BIGINT
  UNION ALL
  SELECT rid, 1000 + tr.height, sub.k // ({FAN} ** tr.height)::BIGINT, hs
  FROM low JOIN sub ON sub.src = low.tree
  JOIN tr ON tr.run = sub.k // ({FAN} ** (tr.height + 1))::BIGINT),
flanks AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY s) AS s,
    array_to_string([x.h for x in hs if x.k < own], '') AS l, array_to_string([x.h for x in hs if x.k > own], '') AS r
  FROM steps),
proof AS (
  SELECT rid, string_agg(l || r, '' ORDER BY s) AS p, list(l || '|' || r ORDER BY s) AS parts FROM flanks GROUP BY rid),
ends AS (
  SELECT rid, p, list_reduce(coalesce(parts, []), lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2)),
    tampered) AS h
  FROM low LEFT JOIN proof USING (rid))
SELECT doc_id, low.h AS leaf, sub.h AS subroot, root.h AS root, sha256(coalesce(p, '')) AS proof_sha256,
  ends.h AS folded_root, ends.h = root.h AS verified
FROM low JOIN sub ON sub.src = low.tree JOIN top root ON root.n = 1
JOIN ends USING (rid)
"""
