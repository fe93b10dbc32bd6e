"""Text encodings of item lists: ``mid:score|mid:score`` and back."""

from pyspark.sql import Column, functions as F

from ratings_spark.constants import ITEM_SEP, LIST_SEP


def encode_recs(recs: str | Column, digits: int | None = None) -> Column:
    """array<struct<mid, r>> -> 'mid:score|mid:score'. Scores are written in
    full, so that decoding gives them back; ``digits`` writes fixed-point."""
    c = F.col(recs) if isinstance(recs, str) else recs

    def score(r):
        return r.cast("string") if digits is None else F.format_string(f"%.{digits}f", r)
    items = F.transform(
        c, lambda x: F.concat(x["mid"].cast("string"), F.lit(ITEM_SEP), score(x["r"])))
    return F.array_join(items, LIST_SEP)


def decode_recs(text: str | Column) -> Column:
    """'mid:score|…' -> array<struct<mid bigint, r double>>; bad items -> NULL
    fields. An empty or NULL string gives an empty array."""
    c = F.col(text) if isinstance(text, str) else text
    parts = F.when(F.trim(c) == "", F.array().cast("array<string>")).otherwise(
        F.split(c, "\\" + LIST_SEP, -1))

    return F.transform(F.coalesce(parts, F.array().cast("array<string>")), decode_item)


def decode_item(text: str | Column) -> Column:
    """One 'mid:score' item -> struct<mid bigint, r double>."""
    c = F.col(text) if isinstance(text, str) else text
    kv = F.split(c, ITEM_SEP, 2)
    return F.struct(F.trim(kv[0]).try_cast("long").alias("mid"),
                    F.trim(F.get(kv, 1)).try_cast("double").alias("r"))
