"""Dictionaries and configuration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.functions.names import camel_columns


def read_base_dic(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary dimension from files."""
    return spark.read.parquet(path).select("dic_code", "info")


def dic_from_dim(rows: DataFrame, sink_table: str = "dim_base_dic") -> DataFrame:
    """The dictionary dimension from maintained dimension rows."""
    return rows.where(F.col("sink_table") == sink_table).select(
        F.col("row_key").alias("dic_code"), F.struct(F.col("data")["dic_name"].alias("dic_name")).alias("info"))


def read_config(spark: SparkSession, path: str | None = None, camel: bool = False, **jdbc: str) -> DataFrame:
    """A configuration table from files, or over JDBC with the given options."""
    table = spark.read.format("jdbc").options(**jdbc).load() if path is None else spark.read.parquet(path)
    return camel_columns(table) if camel else table
