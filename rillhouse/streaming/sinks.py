"""Sinks of streaming queries.

A query runs every ``EVERY`` or, with ``once``, over what is available and then ends. Its progress
lies under ``checkpoint``, a folder that all executors reach.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rillhouse import schemas
from rillhouse.operators.upsert import upsert_latest
from rillhouse.session import release
from rillhouse.streaming.held import HeldRows, Taken, tagged
from rillhouse.streaming.tables import BatchTable, append_batch

EVERY = "60 seconds"
# Places in the change order, one for each side a row was joined from.
VERSIONS = T.ArrayType(schemas.CHANGE_ORDER)
Handle = Callable[[DataFrame, int], None]


def _start(writer: DataStreamWriter, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=EVERY)).start()


def append_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                partition_by: tuple[str, ...] = (), once: bool = False, **options: str) -> StreamingQuery:
    """Append rows to files; each row lands once."""
    writer = df.writeStream.outputMode("append").format(fmt).options(path=path, **options).partitionBy(*partition_by)
    return _start(writer, checkpoint, once)


def topic_rows(rows: DataFrame, topic: str | None = None) -> DataFrame:
    """Rows as (topic, value): all for one topic, or each for the topic it names."""
    if topic is None and "topic" not in rows.columns:
        raise ValueError("no topic given, and rows name none")
    name = F.col("topic") if topic is None else F.lit(topic)
    value = F.col("value") if "value" in rows.columns else F.to_json(F.struct(*rows.columns))
    return rows.select(name.alias("topic"), value.alias("value"))


def topic_sink(rows: DataFrame, checkpoint: str, topic: str | None = None, once: bool = False,
               **options: str) -> StreamingQuery:
    """Append rows to a broker's topics; needs Spark's Kafka package. Rows may arrive twice after a failure."""
    writer = topic_rows(rows, topic).writeStream.outputMode("append").format("kafka").options(**options)
    return _start(writer, checkpoint, once)


def batch_sink(df: DataFrame, handle: Handle, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Hand each micro-batch to ``handle``, with adaptive execution on for the queries it runs."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        handle(batch, batch_id)

    return _start(df.writeStream.foreachBatch(run), checkpoint, once)


def window_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "json", once: bool = False) -> StreamingQuery:
    """Finished windows, exactly once: a batch that runs again replaces its own folder."""
    return batch_sink(df, lambda batch, n: append_batch(batch, path, n, fmt=fmt), checkpoint, once)


def upsert_table(path: str, schema: T.StructType, key: str = "id", **sizes: int) -> BatchTable:
    """The table behind ``upsert_sink``: rows of a schema, without their ``versions`` and batch, by key."""
    own = [T.StructField("versions", VERSIONS), T.StructField("batch_id", T.LongType())]
    full = T.StructType([f for f in schema.fields if f.name not in ("versions", "batch_id")] + own)
    return BatchTable(path, full, (key,), lambda rows: upsert_latest(rows, [key], F.struct("ts", "versions", "batch_id")),
                      merged_batches=True, **sizes)


def band_sink(sides: dict[str, DataFrame], handle: Callable[[Taken, int], None], hold_ms: int, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Hand the rows of several streams that may meet to ``handle``, batch by batch; what later batches need again lies beside the checkpoint."""
    held = HeldRows(f"{checkpoint}/held", tuple(sides), hold_ms)

    def run(batch: DataFrame, n: int) -> None:
        taken = held.take(batch, n)
        handle(taken, n)
        held.done(batch.sparkSession, n, taken)

    return batch_sink(tagged(sides), run, checkpoint, once)


def upsert_sink(sides: dict[str, DataFrame], join: Callable[[Taken], DataFrame], hold_ms: int, path: str, checkpoint: str, once: bool = False,
                key: str = "id", shape: Callable[[DataFrame], DataFrame] = lambda batch: batch, unmatched: str | None = None, **sizes: int) -> StreamingQuery:
    """Joined rows to be read back by key, see ``read_upserts``; of a batch only the latest of each key is written.

    ``shape`` turns each batch's matched rows into rows as they are stored. With ``unmatched``, rows that are not ``matched`` go, as
    they are, to that folder, one folder for each batch. Both are joined on their own, as keeping the rows would take more room than that.
    """
    def handle(taken: Taken, n: int) -> None:
        rows = join(taken)
        matched = shape(rows.where("matched").drop("matched")).withColumn("batch_id", F.lit(n).cast("bigint"))
        table = upsert_table(path, matched.schema, key, **sizes)
        table.add(table.merge(matched), n)
        if unmatched is not None:
            release(rows.sparkSession)
            append_batch(rows.where(~F.col("matched")).drop("matched", "versions"), unmatched, n)

    return band_sink(sides, handle, hold_ms, checkpoint, once)


def read_upserts(spark: SparkSession, path: str, schema: T.StructType, key: str = "id", **sizes: int) -> DataFrame:
    """Latest row per key of what ``upsert_sink`` wrote; among rows of one time, the latest by their sides' ``versions``."""
    return upsert_table(path, schema, key, **sizes).merged(spark).drop("versions", "batch_id")
