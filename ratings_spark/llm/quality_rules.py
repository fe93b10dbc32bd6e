"""Quality rules as a ledger of failure bits.

Every rule is evaluated once on every document. The ledger keeps the
measurements and one number whose bit k says that rule k failed; policies are
masks over these bits, kept by version, so that a policy is applied, compared
or taken apart rule by rule without reading a text again: ``ablations`` first
counts documents by their bits (at most 2^rules rows) and then works on those
counts with bitwise operations.

All measurements are native expressions on one array of the text's words;
nothing is exploded or shuffled. Windows of five words are compared by 64-bit
hash first; only texts in which two hashes agree compare the words themselves.

Defined results: null counts as empty; an empty text has zero in all
measurements and fails ``few_words`` only; ratios over no words or lines are 0.
Rows are one for one with the input, repeated rows, null ids included; an empty
table gives an empty ledger. Extra columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_of, words

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_capitals", "n_same_next")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL condition on the measurements


# The order fixes the bits: append, never reorder.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "5 * n_symbols > n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("capitals", "10 * n_capitals > 4 * word_chars"),
    Rule("word_length", "n_words >= 10 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
    Rule("same_word_again", "n_words >= 10 AND 5 * n_same_next > n_words"),
)
BASE = ("few_words", "repeated_windows")
# A policy is the rules that reject; its mask follows from RULES.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "capitals", "same_word_again"),
    "v2": (*BASE, "symbols", "capitals", "same_word_again", "word_length"),
}
CURRENT = "v2"


def mask(names) -> int:
    """The bits of the named rules."""
    at = {r.name: k for k, r in enumerate(RULES)}
    return sum(1 << at[n] for n in set(names))


def _repeated(w: Column) -> Column:
    """Words that stand in windows found twice or more, each word once."""
    def exact(w):
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.struct(
            F.array_join(F.slice(w, i + 1, F.lit(WINDOW)), " ").alias("words"), i.alias("at")))

        def again(s):
            def same(e, k, by):
                return F.coalesce(F.get(s, k + by)["words"] == e["words"], F.lit(False))
            return F.sort_array(F.transform(
                F.filter(s, lambda e, k: same(e, k, -1) | same(e, k, 1)), lambda e: e["at"]))

        def covered(at):
            steps = F.transform(at, lambda x, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)
        return let(let(F.sort_array(windows), again), covered)

    def looked(w):
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(
            *[F.get(w, i + k) for k in range(WINDOW)]))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), exact(w))
                   .otherwise(0))
    return F.when(F.size(w) > WINDOW, let(w, looked)).otherwise(0)


def _same_next(w: Column) -> Column:
    """Words equal to the word before."""
    return let(w, lambda w: F.size(F.filter(w, lambda x, k: x == F.get(w, k - 1))))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the MEASURES."""
    text = text_of(docs)
    rows = docs.select("doc_id", text.alias("text"), words(text).alias("w"),
                       F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))

    def without(pattern: str) -> Column:
        return (F.length("text") - F.length(F.regexp_replace("text", pattern, ""))).cast("long")

    return rows.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        without(r"[#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("w")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        without(r"[A-Z]+").alias("n_capitals"),
        _same_next(F.col("w")).cast("long").alias("n_same_next"))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed``, the bits of the rules that fail."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(RULES)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured(docs).withColumn("failed", failed.cast("long"))


def apply_policy(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Adds base_failed and kept to ledger rows."""
    def hit(names):
        return F.col("failed").bitwiseAND(F.lit(mask(names)).cast("long")) != 0
    return rows.withColumn("base_failed", hit(BASE)).withColumn("kept", ~hit((*BASE, *POLICIES[policy])))


def ablations(rows: DataFrame, policies: dict | None = None) -> DataFrame:
    """For each policy and each of its rules: documents, ``rejected`` by the
    policy, ``by_rule`` (the rule fails), ``only_rule`` (no other rule of the
    policy fails: what would come back without it)."""
    policies = policies or POLICIES
    table = [(p, r, mask([r]), mask(names)) for p, names in policies.items() for r in names]
    counts = rows.groupBy("failed").agg(F.count("*").alias("n"))
    hit = F.col("failed").bitwiseAND(F.col("mask"))

    def docs_where(c):
        return F.sum(F.when(c, F.col("n")).otherwise(0))
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"),
                                        F.lit(b).cast("long").alias("bit"), F.lit(m).cast("long").alias("mask"))
                               for p, r, b, m in table])).alias("r")
    return (counts.select("failed", "n", each).select("failed", "n", "r.*")
            .groupBy("policy", "rule")
            .agg(F.sum("n").alias("documents"), docs_where(hit != 0).alias("rejected"),
                 docs_where(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("by_rule"),
                 docs_where(hit == F.col("bit")).alias("only_rule")))


def judged(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger under a policy."""
    return apply_policy(ledger(docs), policy)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (
  SELECT rid, i, array_to_string(ws[i:i+4], ' ') AS win
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM g) WHERE c > 1),
cover AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY rid),
nxt AS (
  SELECT rid, count(*) AS n FROM (SELECT rid, ws, unnest(range(2, len(ws) + 1)) AS i FROM w)
  WHERE ws[i] = ws[i-1] GROUP BY rid),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(cover.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
    (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
    coalesce(nxt.n, 0)::BIGINT AS n_same_next
  FROM w LEFT JOIN cover USING (rid) LEFT JOIN nxt USING (rid))
SELECT *, failed & 3 <> 0 AS base_failed, failed & %d = 0 AS kept FROM (
  SELECT *, (%s)::BIGINT AS failed FROM m)
""" % (mask((*BASE, *POLICIES[CURRENT])),
       " + ".join(f"CASE WHEN {r.fails} THEN {1 << k} ELSE 0 END" for k, r in enumerate(RULES)))
