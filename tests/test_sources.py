"""Table reads and writes through Spark's data-source API."""

import pytest
from conftest import rows
from pyspark.sql import types as T

from ratings_spark.session import shared_dir
from ratings_spark.sources import tables


def test_write_read_schema_partitions_and_unique_key(spark):
    path = shared_dir(spark, "test-tables")
    df = spark.createDataFrame([(1, "a", 2024), (1, "a", 2024), (2, "b", 2025)],
                               "mid long, name string, year int")
    tables.write_table(df, path, "parquet", partition_by=["year"], unique_key="mid")
    back = tables.read_table(spark, path)
    assert rows(back, "mid", "name", "year") == [(1, "a", 2024), (2, "b", 2025)]
    # a declared schema is applied as given (no inference), here a column subset
    schema = T.StructType([T.StructField("mid", T.LongType()), T.StructField("year", T.IntegerType())])
    assert tables.read_table(spark, path, schema=schema).columns == ["mid", "year"]
    # overwrite replaces; append adds
    tables.write_table(df.limit(1), path, "parquet", partition_by=["year"])
    assert tables.read_table(spark, path).count() == 1
    tables.write_table(df.limit(1), path, "parquet", mode="append", partition_by=["year"])
    assert tables.read_table(spark, path).count() == 2


def test_other_formats_and_options(spark):
    path = shared_dir(spark, "test-csv")
    df = spark.createDataFrame([(1, "x;y")], "uid long, tag string")
    tables.write_table(df, path, "csv", options={"header": "true", "sep": "|"})
    back = tables.read_table(spark, path, "csv", {"header": "true", "sep": "|"},
                             schema=T.StructType([T.StructField("uid", T.LongType()),
                                                  T.StructField("tag", T.StringType())]))
    assert rows(back) == [(1, "x;y")]


def test_different_rows_with_one_key_are_an_error(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "mid long, name string")
    with pytest.raises(ValueError, match="1 values of mid"):
        tables.write_table(df, shared_dir(spark, "test-key"), unique_key="mid")
