"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse import settings as S


def upsert_latest(df: DataFrame, keys: list[str], order: Column, drop: tuple[str, ...] = ()) -> DataFrame:
    """Keep the last row of each key, without the columns to drop. Partial maxima are built before
    the shuffle."""
    columns = [c for c in df.columns if c not in drop]
    others = [c for c in columns if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("last"))
    return latest.select(*[F.col(c) if c in keys else F.col(f"last.{c}").alias(c) for c in columns])


def latest_config(changes: DataFrame, keys: list[str], fields: tuple[str, ...]) -> DataFrame:
    """Current configuration rows from their change feed: last change per key, deleted keys gone.

    ``reset_ts`` is when the sink was last dropped, by an update or a delete; null if it never was.
    """
    from rillhouse.operators.clean import change_order, effective_row

    rows = effective_row(changes).select(
        *[F.col("data")[f].alias(f) for f in fields], "op", "ts_ms", change_order().alias("seq"))
    current = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*[f for f in fields if f not in keys], "op"), "seq").alias("now"),
        F.max(F.when(F.col("op").isin(S.OP_UPDATE, S.OP_DELETE), F.col("ts_ms"))).alias("reset_ts"))
    return (current.where(F.col("now.op") != S.OP_DELETE)
            .select(*keys, *[F.col(f"now.{f}").alias(f) for f in fields if f not in keys], "reset_ts"))
