"""Personal data: pattern matches, and what their contexts lead to.

Base matches (e-mail, IP, card, phone) are found by regular expressions and
checked (IP parts, Luhn, number of digits). They are also the seeds of a
bootstrap over all documents:

* an occurrence is a base match, or a candidate: a written-out address (``jane at
  example dot com``), a maximal run of two or more groups of digits (spaces, dots,
  brackets, hyphens and slashes in and between them), or a word, the last two with
  at least ``MIN_DIGITS`` digits (or the word with an ``@``). No base match touches
  a candidate, and of candidates that touch, the first of these kinds stands;
* its lexical patterns are the whole word on its left and that on its right;
* a pattern's confidence in a kind is the mean certainty, over all its distinct
  values, that they are of this kind; it counts if at least ``MIN_SUPPORT``
  distinct seeds or accepted values speak for it and it reaches ``MIN_CONFIDENCE``.
  Values of other kinds count as 0. A value still to be judged counts by what the
  pattern tells (1 - the odds of the kind outside the pattern over those within),
  less as far as one of its patterns has fewer of the kind than its size lets expect;
* a value's certainty is 1 - product of (1 - confidence) over its patterns, and
  values from ``MIN_CERTAINTY`` on are accepted into the next round, until one accepts
  nothing that no round before it did.

Candidates accepted in the end are added as spans of the kind found. The graph is
held as the distinct (pattern, value) links, so neither a frequent word nor a
frequent value is gathered anywhere; everything is DataFrame code.

Positions count code points. A match's start is the length of what stands
before it: the text is split by the same expression, and the lengths of gaps and
matches are summed in order.

Defined results: null counts as empty; a text without matches has zero counts,
the digest of an empty string and no spans. Rows are one for one with the input,
repeated rows, null and repeated ids included. An empty table gives an empty
result. Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import text_of

KINDS = ("email", "ip", "card", "phone")
# Possessive, and tried only where a run begins (or a match has ended): the
# same matches in time linear in the text.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "written": (r"(?i)(?<![A-Z0-9._%+-])(?<!dot[)\]]?\x20{1,8})[A-Z0-9._%+-]++(?:_DOT_[A-Z0-9._%+-]++)*+"
                r"_AT_[A-Z0-9-]++(?:_DOT_[A-Z0-9-]++)++").replace("_AT_", r"\x20{1,8}+[(\[]?at[)\]]?\x20{1,8}+")
               .replace("_DOT_", r"\x20{1,8}+[(\[]?dot[)\]]?\x20{1,8}+"),
    # A group that touches a letter ends the run before it, rather than undo it.
    "run": r"(?<![\p{L}0-9@.+(\[/-])_G_(?:[\x20\x09]++(?:[-/.][\x20\x09]++)?_G_)++".replace(
        "_G_", r"[+(\[]*+[0-9](?:[().\[\]/-]*+[0-9])*+[)\]]?+(?![\p{L}0-9@])"),
    "other": r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+",
}
LONG = ("written", "run")  # candidates of several words; the first goes before the second
MIN_DIGITS = 4
MIN_SUPPORT, MIN_CONFIDENCE, MIN_CERTAINTY = 3, 0.8, 0.9


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    ip = value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    card = F.length(digits).between(16, 19) & F.expr("luhn_check(regexp_replace(value, '[^0-9]', ''))")
    phone = F.length(digits).between(8, 15)
    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", ip).when(kind == "card", card)
            .when(kind == "phone", phone).when(kind == "written", F.lit(True))
            .otherwise(value.contains("@") | (F.length(digits) >= MIN_DIGITS)))


def _found(text: Column, kind: str) -> Column:
    """Array of (kind, k, gap, value, left, right), one for each match: the length
    of the gap before it and the whole words on both sides."""
    pattern = PATTERNS[kind]
    sign = {"email": "@", "phone": "+"}.get(kind)
    some = r"(?i)[\x20(\[]dot[\x20)\]]" if kind == "written" else "[0-9@]"
    maybe = text.contains(sign) if sign else F.regexp_like(text, F.lit(some))

    def plain(gap):
        return F.translate(gap, "\t\n\v\f\r", " " * 5)

    def rows(text):
        def zipped(values):
            def with_gaps(gaps):
                return F.transform(values, lambda v, k: F.struct(
                    F.lit(kind).alias("kind"), k.alias("k"),
                    F.length(F.get(gaps, k)).alias("gap"), v.alias("value"),
                    F.substring_index(F.rtrim(plain(F.get(gaps, k))), " ", -1).alias("left"),
                    F.substring_index(F.ltrim(plain(F.get(gaps, k + 1))), " ", 1).alias("right")))
            return F.transform(F.array(F.split(text, pattern, -1)), with_gaps)[0]
        return F.transform(F.array(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), zipped)[0]
    empty = F.array().cast("array<struct<kind:string,k:int,gap:int,value:string,left:string,right:string>>")
    return F.when(maybe, rows(text)).otherwise(empty)


def occurrences(docs: DataFrame) -> DataFrame:
    """Base matches and candidates: rid (a number of the row), doc_id, kind,
    start, end, value, left, right. Matches that fail their check have a null
    kind, as has the one row of an input row without matches. Written out, as
    the rounds read it again."""
    text = text_of(docs)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", text.alias("text"))
    found = F.concat(*[_found(F.col("text"), k) for k in PATTERNS])
    rows = rows.select("rid", "doc_id", F.explode_outer(found).alias("m")).select("rid", "doc_id", "m.*")
    so_far = (Window.partitionBy("rid", "kind").orderBy("k")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    n = F.length("value")
    # One shuffle by row serves all windows; every row of the input keeps one.
    rows = (rows.repartition("rid").withColumn("end", F.sum(F.col("gap") + n).over(so_far).cast("long"))
            .withColumn("start", F.col("end") - n))
    good = rows.withColumn("kind", F.when(_valid(F.col("kind"), F.col("value")), F.col("kind")))
    base = F.col("kind").isin(*KINDS)
    # A candidate that a base match touches is not one, nor one that a longer
    # candidate touches: compare it with the furthest end before it and the nearest
    # start after it.
    rank = F.when(base, 0).when(F.col("kind") == LONG[0], 1).when(F.col("kind") == LONG[1], 2).otherwise(3)
    good = good.withColumn("rank", rank)
    by_start = Window.partitionBy("rid").orderBy("start", "end", "rank")
    by_end = Window.partitionBy("rid").orderBy(F.col("end").desc(), F.col("start").desc(), "rank")
    for level in (1, 2, 3):
        above = F.col("kind").isNotNull() & (F.col("rank") < level)
        past = F.max(F.when(above, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
        next_ = F.min(F.when(above, F.col("start"))).over(by_end.rowsBetween(Window.unboundedPreceding, -1))
        good = good.withColumns({"past": past, "next": next_})
        free = ((F.coalesce(F.col("past"), F.lit(0)) <= F.col("start"))
                & (F.coalesce(F.col("next"), F.col("end")) >= F.col("end")))
        good = good.withColumn("kind", F.when((F.col("rank") != level) | free, F.col("kind")))
    return materialize(good.select(
        "rid", "doc_id", F.when(F.col("kind").isin(*LONG), "other").otherwise(F.col("kind")).alias("kind"),
        "start", "end", "value", F.lower("left").alias("left"), F.lower("right").alias("right")), "pii-found")


def discover(found: DataFrame) -> DataFrame:
    """(value, kind): the candidates' values that the bootstrap accepts."""
    found = found.where("kind IS NOT NULL")
    sides = F.explode(F.array(F.concat(F.lit("l "), "left"), F.concat(F.lit("r "), "right")))
    links = (found.select("kind", "value", sides.alias("pattern"))
             .where(F.length("pattern") > 2).distinct())
    links = materialize(links.select("pattern", "value", "kind"), "pii-links")
    values = links.select("value", "kind").distinct()
    seeds = links.where("kind <> 'other'").withColumn("certainty", F.lit(1.0))
    total = values.select("value").distinct().agg(F.count("*").alias("total"))
    size = links.select("pattern", "value").distinct().groupBy("pattern").agg(F.count("*").alias("n"))
    others = links.where("kind = 'other'").drop("kind")
    known = ever = None
    while True:
        sure, unjudged = seeds, others
        of_kind = values.where("kind <> 'other'").select("value", "kind", F.lit(1.0).alias("certainty"))
        if known is not None:
            sure = sure.unionByName(others.join(known, "value"))
            unjudged = others.join(known, "value", "left_anti")
            of_kind = of_kind.unionByName(known.select("value", "kind", "certainty"))
        judged = of_kind.groupBy("kind").agg(F.sum("certainty").alias("judged"))
        # A pattern tells as far as its share of the kind is not what chance gives
        # at the share of the kind outside it.
        outside = F.greatest((F.col("judged") - F.col("mass")) / F.greatest(F.col("total") - F.col("n"), F.lit(1)),
                             F.lit(0.0))
        chance = (outside * (F.col("n") - F.col("mass"))) / F.greatest((1 - outside) * F.col("mass"), F.lit(1e-9))
        seen = (sure.groupBy("pattern", "kind")
                .agg(F.sum("certainty").alias("mass"), F.count("*").alias("support"))
                .join(size, "pattern").join(F.broadcast(judged), "kind").crossJoin(F.broadcast(total))
                .withColumn("telling", F.when(F.col("support") >= MIN_SUPPORT, 1 - F.least(chance, F.lit(1.0)))
                            .otherwise(F.lit(0.0))))
        seen = materialize(seen, "pii-patterns")
        # Unjudged values at their current certainty: the most that a pattern tells,
        # less what the pattern tells that has the fewest of the kind for its size.
        now = materialize(
            unjudged.join(seen.where("telling > 0").select("pattern", "kind", "telling"), "pattern")
            .groupBy("value", "kind").agg(F.max("telling").alias("telling")), "pii-now")
        mass = (unjudged.join(now, "value").groupBy("pattern", "kind").agg(F.sum("telling").alias("more")))
        held = (now.select("value", "kind").join(unjudged, "value")
                .join(size, "pattern").join(seen.select("pattern", "kind", "mass"), ["pattern", "kind"], "left")
                .join(mass, ["pattern", "kind"], "left")
                .join(F.broadcast(judged), "kind").crossJoin(F.broadcast(total)))
        expected = F.col("n") * F.col("judged") / F.col("total")
        held = (held.withColumn("ratio", (F.coalesce("mass", F.lit(0.0)) + F.coalesce("more", F.lit(0.0)) + 1)
                                / (expected + 1))
                .groupBy("value", "kind").agg(F.least(F.min("ratio"), F.lit(1.0)).alias("left_over")))
        weight = (unjudged.join(held, "value").groupBy("pattern", "kind").agg(F.sum("left_over").alias("open")))
        patterns = (seen.where(F.col("support") >= MIN_SUPPORT).join(weight, ["pattern", "kind"], "left")
                    .withColumn("confidence", (F.col("mass") + F.col("telling") * F.coalesce("open", F.lit(0.0)))
                                / F.col("n"))
                    .where(F.col("confidence") >= MIN_CONFIDENCE))
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))
        scored = (others.join(patterns.select("pattern", "kind", "confidence"), "pattern")
                  .groupBy("value", "kind").agg((1 - doubt).alias("certainty"))
                  .where(F.col("certainty") >= MIN_CERTAINTY))
        best = F.max(F.struct("certainty", "kind")).alias("b")
        known = materialize(scored.groupBy("value").agg(best).select("value", "b.kind", "b.certainty"),
                            "pii-known")
        fresh = known.select("value", "kind")
        if ever is not None:
            fresh = fresh.join(ever, ["value", "kind"], "left_anti")
        if fresh.isEmpty():
            return known.select("value", "kind")
        ever = fresh if ever is None else materialize(ever.unionByName(fresh), "pii-ever")


def spans(docs: DataFrame) -> DataFrame:
    """One row per span: rid, doc_id, kind, start, end, value, base (whether a
    base match). Rows of null kind are no spans; they keep each input row."""
    found = occurrences(docs)
    new = discover(found).withColumnRenamed("kind", "found_kind")
    base = found.where("kind IS NULL OR kind <> 'other'").withColumn("base", F.col("kind").isNotNull())
    others = (found.where("kind = 'other'").join(new, "value", "left")
              .withColumn("kind", F.col("found_kind")).drop("found_kind").withColumn("base", F.lit(False)))
    return base.unionByName(others)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone and
    base_sha256 of the base matches, ``spans`` of all, n_found of those that
    the contexts added."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    one = F.struct(order.alias("o"), "start", "end", F.concat_ws(":", "kind", "start", "end").alias("s"))

    def text(rows):
        return F.array_join(F.transform(F.array_sort(rows), lambda x: x["s"]), ",")
    rows = spans(docs).groupBy("rid", "doc_id").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS],
        F.collect_list(F.when(F.col("base"), one)).alias("base"),
        F.collect_list(F.when(F.col("kind").isNotNull(), one)).alias("all"),
        F.count(F.when(~F.col("base") & F.col("kind").isNotNull(), 1)).alias("n_found"))
    return rows.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(text("base"), 256).alias("base_sha256"),
                       text("all").alias("spans"), "n_found")
