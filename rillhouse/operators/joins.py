"""Dictionary lookups, time-banded joins and configuration routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse import settings as S
from rillhouse.operators.clean import effective_row
from rillhouse.operators.skew import join_small, salted


def lookup(df: DataFrame, dic: DataFrame, code: str, name: str, how: str = "left") -> DataFrame:
    """Add the dictionary name of a code."""
    names = dic.select(F.col("dic_code").alias(code), F.col("info.dic_name").alias(name))
    return join_small(df, names, [code], how)


def interval_join(events: DataFrame, rows: DataFrame, key: str, time: str = "et", row_time: str = "row_et",
                  before_ms: int = S.PAY_BEFORE_MS, after_ms: int = S.PAY_AFTER_MS, salts: int = 1,
                  spread: bool = True) -> DataFrame:
    """Rows with the same key whose time lies in [event - before, event + after], ends included.

    Both sides meet on (key, time bucket): an event goes to the one or two buckets its band touches,
    a row to just one. A pair thus meets once, and a key with very many rows is spread over time. Rows
    of one key at one time are split by adaptive execution or, on streams, by ``salts``. Where no key has many rows, the
    sides can do without (``spread=False``): rows that lie partitioned by the key then stay where they are.
    """
    band = F.expr(f"{row_time} BETWEEN {time} - INTERVAL '{before_ms / 1000}' SECOND "
                  f"AND {time} + INTERVAL '{after_ms / 1000}' SECOND")
    if not spread:
        same = F.col(f"l.{key}") == F.col(f"r.{key}")
        return events.alias("l").join(rows.alias("r"), same & band).drop(F.col(f"r.{key}"))
    width = before_ms + after_ms + 1
    event_ms, row_ms = F.unix_millis(time), F.unix_millis(row_time)
    first = F.floor((event_ms - before_ms) / width)
    last = F.floor((event_ms + after_ms) / width)
    left = events.withColumn("bucket", F.explode(F.array_distinct(F.array(first, last))))
    right = rows.withColumn("bucket", F.floor(row_ms / width))
    right, left = salted(right, left, salts)
    joined = left.alias("l").join(
        right.alias("r"),
        (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col("l.bucket") == F.col("r.bucket"))
        & (F.col("l.salt") == F.col("r.salt")) & band)
    return joined.drop(F.col("r.bucket"), F.col("r.salt"), F.col(f"r.{key}")).drop("bucket", "salt")


def route_changes(changes: DataFrame, config: DataFrame, by_op: bool = False) -> DataFrame:
    """Changes of configured tables, with their configuration; ``by_op`` also matches the operation.

    Rows from before the sink's last reset are left out, as they were dropped with it.
    """
    rows = effective_row(changes).withColumn("source_table", F.col("source")["table"])
    if by_op:
        return rows.withColumn("source_type", F.col("op")).transform(
            lambda r: join_small(r, config, ["source_table", "source_type"]))
    routed = join_small(rows, config, ["source_table"])
    return routed.where(F.col("reset_ts").isNull() | (F.col("ts_ms") > F.col("reset_ts")))
