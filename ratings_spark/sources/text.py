"""Parsers for the delimited text inputs, with a quarantine for bad lines.

Each ``parse_*`` takes a DataFrame with a string column ``value`` (what
``spark.read.text`` yields) and returns ``(good, bad)``: typed rows, and the
rejected lines with a reason. Nothing aborts the job on a malformed line.
Fields are split keeping trailing empty strings, trimmed and cast with
``try_cast``; the original line-by-line loader failed the whole job instead.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratings_spark.constants import MESSAGE_SEP, MOVIE_SEP, RATING_SEP, TAG_SEP
from ratings_spark.schemas import MOVIE_TEXT_COLUMNS


def _split(sep: str) -> Column:
    return F.split(F.col("value"), "\\" + sep if sep in "^|.$*+?()[]{}\\" else sep, -1)


def _field(parts: Column, i: int) -> Column:
    return F.trim(F.get(parts, i))


def _reason(*checks: tuple[Column, str]) -> Column:
    """First failing check's message, NULL when all pass."""
    expr = F.lit(None).cast("string")
    for bad, msg in reversed(checks):
        expr = F.when(bad, F.lit(msg)).otherwise(expr)
    return expr


def number(text: Column) -> Column:
    """The text as a finite double, else null: one NaN or infinity among the
    scores would turn every mean it enters into itself."""
    return _finite(text.try_cast("double"))


def _finite(x: Column) -> Column:
    return F.when(F.abs(x) <= sys.float_info.max, x)


def _flag(lines: DataFrame, parts: Column, fields: list[Column], reason: Column,
          *keep: str) -> DataFrame:
    """value, the fields and reason. The line is split once, below a generator
    that holds the fields: filters on them stay above it, where a plain
    projection would be repeated in every filter."""
    rows = lines.select("value", *keep, parts.alias("_p"))
    row = F.struct(*fields, reason.alias("reason"))
    return rows.select("value", *keep, F.inline(F.array(row)))


def _finish(flagged: DataFrame, *skip: str) -> tuple[DataFrame, DataFrame]:
    good = flagged.where(F.col("reason").isNull()).drop("value", "reason", *skip)
    bad = flagged.where(F.col("reason").isNotNull()).select("value", "reason")
    return good, bad


def flag_movies(lines: DataFrame) -> DataFrame:
    p = F.col("_p")
    mid = _field(p, 0).try_cast("int")
    fields = [mid.alias("mid")] + [_field(p, i + 1).alias(c) for i, c in enumerate(MOVIE_TEXT_COLUMNS)]
    return _flag(lines, _split(MOVIE_SEP), fields, _reason(
        (F.size(p) < 10, "fewer than 10 fields"),
        (mid.isNull(), "mid is not an integer"),
    ))


def parse_movies(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``mid^name^descri^timelong^issue^shoot^language^genres^actors^directors``.

    Extra trailing fields are ignored; fewer than 10 fields or a non-integer
    ``mid`` send the line to quarantine.
    """
    return _finish(flag_movies(lines))


def flag_ratings(lines: DataFrame) -> DataFrame:
    p = F.col("_p")
    uid, mid = _field(p, 0).try_cast("int"), _field(p, 1).try_cast("int")
    score, ts = number(_field(p, 2)), _field(p, 3).try_cast("long")
    fields = [uid.alias("uid"), mid.alias("mid"), score.alias("score"), ts.alias("timestamp")]
    return _flag(lines, _split(RATING_SEP), fields, _reason(
        (F.size(p) < 4, "fewer than 4 fields"),
        (uid.isNull(), "uid is not an integer"),
        (mid.isNull(), "mid is not an integer"),
        (score.isNull(), "score is not a finite number"),
        (ts.isNull(), "timestamp is not an integer"),
    ))


def parse_ratings(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``uid,mid,score,timestamp`` (epoch seconds)."""
    return _finish(flag_ratings(lines))


def flag_tags(lines: DataFrame) -> DataFrame:
    p = F.col("_p")
    n = F.size(p)
    uid, mid = _field(p, 0).try_cast("int"), _field(p, 1).try_cast("int")
    ts = F.trim(F.get(p, n - 1)).try_cast("long")
    raw = F.trim(F.array_join(F.slice(p, F.lit(3), F.greatest(n - 3, F.lit(0))), TAG_SEP))
    quoted = raw.startswith('"') & raw.endswith('"') & (F.length(raw) >= 2)
    inner = F.substring(raw, F.lit(2), F.length(raw) - 2)
    tag = F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(raw)
    fields = [uid.alias("uid"), mid.alias("mid"), tag.alias("tag"), ts.alias("timestamp")]
    return _flag(lines, _split(TAG_SEP), fields, _reason(
        (n < 4, "fewer than 4 fields"),
        (uid.isNull(), "uid is not an integer"),
        (mid.isNull(), "mid is not an integer"),
        (ts.isNull(), "timestamp is not an integer"),
    ))


def parse_tags(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``uid,mid,tag,timestamp``; the tag is everything between the second
    and the last comma, so a tag holding commas survives. A tag wrapped in
    double quotes is unquoted (``""`` inside becomes ``"``)."""
    return _finish(flag_tags(lines))


def flag_messages(lines: DataFrame, *keep: str) -> DataFrame:
    p = F.col("_p")
    uid, mid = _field(p, 0).try_cast("long"), _field(p, 1).try_cast("long")
    score, ts = number(_field(p, 2)), _field(p, 3).try_cast("long")
    fields = [uid.alias("uid"), mid.alias("mid"), score.alias("score"), ts.alias("timestamp"),
              _field(p, 4).try_cast("long").alias("msg_id")]
    return _flag(lines, _split(MESSAGE_SEP), fields, _reason(
        (F.size(p) < 4, "fewer than 4 fields"),
        (uid.isNull() | mid.isNull(), "uid or mid is not an integer"),
        (score.isNull(), "score is not a finite number"),
        (ts.isNull(), "timestamp is not an integer"),
    ), *keep)


def parse_messages(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rating messages ``uid|mid|score|timestamp`` with an optional fifth
    field, a message id used to order messages of the same second."""
    return _finish(flag_messages(lines))


def parse_csv(lines: DataFrame, schema, sep: str = ",",
              quote: str = '"') -> tuple[DataFrame, DataFrame]:
    """CSV parsing of a ``value`` column with ``from_csv`` in PERMISSIVE
    mode: ``(good, bad)`` like the other parsers. A line that does not fit
    ``schema`` (too few fields, a bad number) is quarantined with the first
    invalid field named; quoted fields may hold the separator (``""`` is an
    escaped quote). Values are trimmed."""
    corrupt = "_corrupt_record"
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "sep": sep,
            "quote": quote, "escape": quote, "ignoreLeadingWhiteSpace": "true",
            "ignoreTrailingWhiteSpace": "true"}
    # Below a generator, as in _flag, so that filters do not parse again.
    row = F.from_csv("value", f"{ddl}, `{corrupt}` string", opts)
    r = lines.select("value", F.explode(F.array(row)).alias("_r"))
    wild = [F.col(f"_r.`{f.name}`").isNotNull() & _finite(F.col(f"_r.`{f.name}`")).isNull()
            for f in schema.fields if f.dataType.simpleString() in ("float", "double")]
    bad_line = F.col(f"_r.{corrupt}").isNotNull()
    for w in wild:
        bad_line = bad_line | w
    good = r.where(~bad_line).select(*[F.col(f"_r.`{f.name}`").alias(f.name)
                                       for f in schema.fields])
    reason = F.coalesce(*[F.when(F.col(f"_r.`{f.name}`").isNull(),
                                 F.lit(f"{f.name} missing or invalid")) for f in schema.fields],
                        *[F.when(w, F.lit("not a finite number")) for w in wild],
                        F.lit("does not match the schema"))
    bad = r.where(bad_line).select("value", reason.alias("reason"))
    return good, bad


def read_csv_table(spark: SparkSession, path: str, schema, sep: str = ",",
                   quote: str = '"') -> tuple[DataFrame, DataFrame]:
    """``parse_csv`` over the lines of text files."""
    return parse_csv(spark.read.text(path), schema, sep, quote)
