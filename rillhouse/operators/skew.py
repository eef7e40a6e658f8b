"""Joins whose left key may hold a large share of all rows, and joins with small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot when it holds at least this share of all rows, so at most this many keys are hot, and
# at least this many rows, as fewer are no burden to one task.
MAX_HOT_KEYS = 2048
HOT_SHARE = 1 / MAX_HOT_KEYS
MIN_HOT_ROWS = 10_000
# A hot key's rows are dealt to this many tasks.
HOT_SALTS = 32
# Keys each sketch tracks; its error stays well below the hot share.
TRACKED_KEYS = 16_384
# A table of at most this many rows and bytes, counted before the join, is broadcast.
MAX_BROADCAST_ROWS = 50_000
MAX_BROADCAST_BYTES = 32 << 20
# Sketches of many tasks are merged in this many groups before the last merge.
MERGE_GROUPS = 512


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Keys holding at least ``share`` of the rows and ``rows`` of them: one sketch per task, merged in
    two steps, no shuffle of rows."""
    grouped = df.where(F.col(key).isNotNull()).withColumn("g", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    sketches = grouped.groupBy("g").agg(
        F.expr(f"approx_top_k_accumulate({key}, {TRACKED_KEYS})").alias("sketch"),
        F.count(F.lit(1)).alias("n"))
    # Grouped by a constant: without rows there is then no sketch to combine, and no hot key.
    merged = sketches.groupBy(F.lit(1).alias("all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {TRACKED_KEYS})").alias("sketch"), F.sum("n").alias("total"))
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {MAX_HOT_KEYS})")).alias("t"), "total")
    return top.where(F.col("t.count") >= F.greatest(F.col("total") * share, F.lit(rows))).select(F.col("t.item").alias(key))


def _hash_of(df: DataFrame) -> Column:
    """A hash of each row's columns. Maps count by their entries; what holds maps within is left out."""
    def holds_map(kind: T.DataType) -> bool:
        return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and holds_map(kind.elementType) or \
            isinstance(kind, T.StructType) and any(holds_map(f.dataType) for f in kind.fields)

    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.MapType) and not holds_map(f.dataType.valueType):
            columns.append(F.map_entries(f.name))
        elif not holds_map(f.dataType):
            columns.append(F.col(f.name))
    return F.xxhash64(*columns)


def splits_skew(spark: SparkSession) -> bool:
    """Whether adaptive execution splits partitions that one key has filled."""
    return all(spark.conf.get(f"spark.sql.adaptive.{name}", "true") == "true" for name in ("enabled", "skewJoin.enabled"))


def join_hot_split(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float = HOT_SHARE,
                   keys_from: DataFrame | None = None, rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Equi-join in which the left side may be skewed and the right side is unique by ``key``. Both sides are planned once.

    Where adaptive execution splits skewed partitions this is a plain join: the shuffle's own statistics show hot
    keys, whose rows lie in many map outputs and are read apart. Otherwise hot keys are looked for first, in one pass over the key
    alone; ``keys_from`` names a cheaper input for that than the left side. The left rows of hot keys are then dealt to
    ``HOT_SALTS`` tasks by a hash of the row, and the right rows of these at most ``MAX_HOT_KEYS`` keys are repeated for each.
    Neither changes the result.
    """
    if splits_skew(left.sparkSession):
        return left.join(right, key, how)
    source = (left if keys_from is None else keys_from).select(key)
    hot = [r[0] for r in hot_keys(source, key, share, rows).collect()]
    if not hot:
        return left.join(right, key, how)
    is_hot = F.col(key).isin(hot)
    one = F.when(is_hot, F.pmod(_hash_of(left), F.lit(HOT_SALTS))).otherwise(0)
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted_left = left.withColumn("join_salt", one.cast("int"))
    return salted_left.join(right.withColumn("join_salt", F.explode(every)), [key, "join_salt"], how).drop("join_salt")


def is_small(table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the table's rows, counted, and their texts' bytes, summed, stay within the bounds."""
    size = F.octet_length(F.to_json(F.struct(*table.columns)))
    found = table.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    return found["n"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def join_small(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
               max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Equi-join with a table that is unique by ``keys`` and expected to be small.

    Its rows and bytes are counted first. Within bounds it is broadcast, so that the left side, whose few
    keys each hold much of the data, is not shuffled by them. Beyond, hot keys are split off.
    """
    if is_small(right, max_rows):
        return left.join(F.broadcast(right), keys, how)
    if left.isStreaming:
        return left.join(right, keys, how)
    if len(keys) == 1:
        return join_hot_split(left, right, keys[0], how)
    whole = F.when(F.expr(" AND ".join(f"{k} IS NOT NULL" for k in keys)), F.to_json(F.struct(*keys)))
    right = right.withColumn("join_key", whole).drop(*keys)
    return join_hot_split(left.withColumn("join_key", whole), right, "join_key", how).drop("join_key")


def salted(left: DataFrame, right: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``salt`` to join on as well: left rows get one each, right rows all.

    Streams are joined without adaptive execution, so this is how their hot keys spread over tasks.
    """
    if salts == 1:
        return left.withColumn("salt", F.lit(0)), right.withColumn("salt", F.lit(0))
    one = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    return left.withColumn("salt", one), right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
