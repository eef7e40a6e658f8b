"""Static writes, and the JSON shapes of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.functions.names import snake_columns


def to_json_rows(df: DataFrame) -> DataFrame:
    """Rows as JSON ``value``; null fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def to_snake_json(df: DataFrame, transient: tuple[str, ...] = ()) -> DataFrame:
    """Rows as JSON with snake_case names, without the transient columns."""
    return to_json_rows(snake_columns(df.drop(*transient)))


def route_sink(rows: DataFrame, path: str, route: str = "sink_table", fmt: str = "json") -> None:
    """Append rows to one folder per route.

    The rebalance lets adaptive execution split a route that holds much of the data over many tasks
    and keep small routes in few files.
    """
    rows.hint("rebalance", route).write.mode("append").partitionBy(route).format(fmt).save(path)
