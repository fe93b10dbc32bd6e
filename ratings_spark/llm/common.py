"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but these characters (space, \t \n \v \f \r).
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs: DataFrame) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text."""
    return F.array_remove(F.split(text, SPACES), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once (bound as a lambda
    variable), where a plain reference would be recomputed at each use."""
    return F.transform(F.array(value), body)[0]


def schema_sql(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
