"""Batch sources with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row; an empty field is NULL."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines; a line that does not parse keeps its text in `_corrupt_record`."""
    with_rejects = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(with_rejects).json(path)


def read_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"`{database}`.`{name}`")


READERS = {"csv": read_csv, "json": read_json_lines}
