"""File and catalog readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV with an explicit schema: no inference pass over the data; malformed values become NULL."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or a parquet path if the name contains a slash."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
