"""Dimension tables from routed changes, cell by cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse import settings as S
from rillhouse.operators.clean import change_order
from rillhouse.operators.skew import join_small

# Name of the cell that records a row's last delete.
DELETED = ""


def dim_cells(routed: DataFrame) -> DataFrame:
    """Last write of every cell, as (sink_table, row_key, cell, seq, text).

    A delete is a write to the cell ``DELETED``. The result can be merged with other such results
    by ``merge_cells``: order of arrival and repeats do not matter.
    """
    keyed = routed.select(
        "sink_table", F.col("data")[F.col("sink_row_key")].alias("row_key"), "op", "data", "sink_columns",
        change_order().alias("seq")).where(F.col("row_key").isNotNull())
    wanted = F.split("sink_columns", ",")
    written = F.map_filter("data", lambda k, v: v.isNotNull() & F.array_contains(wanted, k))
    deleted = F.create_map(F.lit(DELETED), F.lit(""))
    cells = keyed.select(
        "sink_table", "row_key", "seq",
        F.explode(F.when(F.col("op") == S.OP_DELETE, deleted).otherwise(written)).alias("cell", "text"))
    return merge_cells(cells)


def merge_cells(cells: DataFrame) -> DataFrame:
    """Keep the last write of every cell."""
    return (cells.groupBy("sink_table", "row_key", "cell")
            .agg(F.max(F.struct("seq", "text")).alias("last"))
            .select("sink_table", "row_key", "cell", "last.seq", "last.text"))


def dim_rows(cells: DataFrame) -> DataFrame:
    """Rows as (sink_table, row_key, data): cells written after the row's last delete."""
    rows = cells.groupBy("sink_table", "row_key").agg(
        F.max(F.when(F.col("cell") == DELETED, F.col("seq"))).alias("gone"),
        F.collect_list(F.when(F.col("cell") != DELETED, F.struct("cell", "text", "seq"))).alias("cells"))
    alive = F.filter("cells", lambda c: F.col("gone").isNull() | (c["seq"] > F.col("gone")))
    data = F.map_from_entries(F.transform(alive, lambda c: F.struct(c["cell"], c["text"])))
    return rows.select("sink_table", "row_key", data.alias("data")).where(F.size("data") > 0)


def dim_merge(routed: DataFrame) -> DataFrame:
    """Current dimension rows: deletes remove a row, nulls leave a cell as it was."""
    return dim_rows(dim_cells(routed))


def dim_config_reset(cells: DataFrame, config: DataFrame) -> DataFrame:
    """Cells of configured sinks, written after the sink's last reset."""
    resets = config.groupBy("sink_table").agg(F.max("reset_ts").alias("reset_ts"))
    return (join_small(cells, resets, ["sink_table"])
            .where(F.col("reset_ts").isNull() | (F.col("seq.ts_ms") > F.col("reset_ts")))
            .drop("reset_ts"))


def dim_table(rows: DataFrame, sink_table: str, columns: list[str]) -> DataFrame:
    """One dimension table with one column per configured column."""
    return rows.where(F.col("sink_table") == sink_table).select(
        "row_key", *[F.col("data")[c].alias(c) for c in columns])
