"""The warehouse jobs as running queries: inputs in, tables out.

``config`` arguments are functions that read the configuration change feed; they are called once
per micro-batch, so that changes take effect with the next batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rillhouse import schemas, settings as S
from rillhouse.functions.times import event_time
from rillhouse.operators import dims
from rillhouse.operators import facts as P
from rillhouse.operators import visitors as V
from rillhouse.operators.bands import FRESH
from rillhouse.operators.clean import Changes, clean_json
from rillhouse.operators.joins import route_changes
from rillhouse.operators.logs import split_log, with_device
from rillhouse.plans import bands
from rillhouse.plans import facts as PF
from rillhouse.plans import routing as PR
from rillhouse.plans import traffic as PT
from rillhouse.session import disk_state
from rillhouse.streaming import facts as SF
from rillhouse.streaming.held import Taken
from rillhouse.streaming.sinks import append_sink, band_sink, batch_sink, upsert_sink, window_sink
from rillhouse.streaming.tables import BatchTable, append_batch
from rillhouse.streaming.visitors import repair_batch

Config = Callable[[SparkSession], DataFrame]

CELLS = T.StructType([
    T.StructField("sink_table", T.StringType()), T.StructField("row_key", T.StringType()),
    T.StructField("cell", T.StringType()), T.StructField("seq", schemas.CHANGE_ORDER),
    T.StructField("text", T.StringType()),
])


def ods_ingest(lines: DataFrame, path: str, checkpoint: str, once: bool = False, files: int = 4) -> StreamingQuery:
    """Land the change feed by source table and day; later jobs read only the tables they need, see ``read_ods``.

    A batch writes at most ``files`` files for each table and day, and spreads a table that holds much of the feed over them.
    """
    records = PR.ods_ingest(lines)
    dealt = records.repartition("source_table", "day", F.pmod(F.xxhash64("value"), F.lit(files)))
    return append_sink(dealt, path, checkpoint, partition_by=("source_table", "day"), once=once, compression="zstd")


def dim_table(path: str, **sizes: int) -> BatchTable:
    """The cells of all dimension rows."""
    return BatchTable(path, CELLS, ("sink_table", "row_key"), dims.merge_cells, **sizes)


def dim_sync(changes: DataFrame, config: Config, path: str, checkpoint: str, once: bool = False, **sizes: int) -> StreamingQuery:
    """Keep dimensions current. A batch adds the cells it writes; ``read_dims`` merges them."""
    def handle(batch: DataFrame, n: int) -> None:
        routed = route_changes(batch, PR.dim_config(config(batch.sparkSession)))
        dim_table(path, **sizes).add(dims.dim_cells(routed), n)

    return batch_sink(changes, handle, checkpoint, once)


def read_dims(spark: SparkSession, path: str, config: Config, **sizes: int) -> DataFrame:
    """Current dimension rows, as (sink_table, row_key, data)."""
    cells = dim_table(path, **sizes).merged(spark)
    return dims.dim_rows(dims.dim_config_reset(cells, PR.dim_config(config(spark))))


def dwd_base_log(lines: DataFrame, path: str, state: str, checkpoint: str, once: bool = False,
                 order: tuple[str, ...] = V.ORDER, **sizes: int) -> StreamingQuery:
    """Repair and split application logs into one folder of JSON lines per topic."""
    def handle(batch: DataFrame, n: int) -> None:
        # Parsed once for the first visits, the repair and the split; lost blocks are parsed again.
        logs = batch.persist()
        try:
            append_batch(split_log(repair_batch(logs, n, state, order, **sizes)), path, n, ("topic",), "text")
        finally:
            logs.unpersist()

    return batch_sink(with_device(clean_json(lines, schemas.APP_LOG)), handle, checkpoint, once)


def dwd_base_db(changes: DataFrame, config: Config, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Route configured rows into one folder of JSON lines per sink."""
    def handle(batch: DataFrame, n: int) -> None:
        append_batch(PR.dwd_base_db(batch, config(batch.sparkSession)), path, n, ("sink_table",), "text")

    return batch_sink(changes, handle, checkpoint, once)


def dwd_comment(changes: DataFrame, dic: Config, path: str, checkpoint: str, db: str = S.SOURCE_DB,
                once: bool = False) -> StreamingQuery:
    def handle(batch: DataFrame, n: int) -> None:
        append_batch(PF.dwd_comment(batch, dic(batch.sparkSession), db), path, n)

    return batch_sink(changes, handle, checkpoint, once)


def dwd_cart_add(changes: DataFrame, path: str, checkpoint: str, db: str = S.SOURCE_DB,
                 once: bool = False) -> StreamingQuery:
    return append_sink(PF.dwd_cart_add(changes, db), path, checkpoint, once=once)


def dwd_order_detail(changes: Changes, path: str, checkpoint: str, db: str = S.SOURCE_DB, once: bool = False,
                     band_ms: int = S.ORDER_BAND_MS, unmatched: str | None = None, **sizes: int) -> StreamingQuery:
    """Order details, to be read with ``read_upserts``. ``unmatched`` names a folder for details whose order has not come in the band."""
    return _detail_upserts(changes, P.order_info_src(changes, db), path, checkpoint, db, once, band_ms, band_ms, unmatched, **sizes)


def dwd_order_cancel(changes: Changes, path: str, checkpoint: str, db: str = S.SOURCE_DB, once: bool = False,
                     wait_ms: int = S.CANCEL_BAND_MS, band_ms: int = S.ORDER_BAND_MS, **sizes: int) -> StreamingQuery:
    """Details of orders cancelled within ``wait_ms``; all other details are unmatched by nature and not kept."""
    return _detail_upserts(changes, P.order_cancel_src(changes, db), path, checkpoint, db, once, band_ms, wait_ms, None, **sizes)


def _detail_upserts(changes: Changes, orders: DataFrame, path: str, checkpoint: str, db: str, once: bool, before_ms: int, after_ms: int,
                    unmatched: str | None, **sizes: int) -> StreamingQuery:
    def join(taken: Taken) -> DataFrame:
        return bands.join_details(taken.rows, before_ms, after_ms, taken.before, taken.after)

    return upsert_sink(bands.detail_sides(changes, orders, db), join, before_ms + after_ms, path, checkpoint, once, unmatched=unmatched, **sizes)


def dwd_pay_suc(changes: Changes, order_detail: DataFrame, dic: Config, path: str, checkpoint: str,
                db: str = S.SOURCE_DB, once: bool = False, before_ms: int = S.PAY_BEFORE_MS,
                after_ms: int = S.PAY_AFTER_MS) -> StreamingQuery:
    """Paid details, one folder for each batch; names are those the dictionary has when the batch runs."""
    def handle(taken: Taken, n: int) -> None:
        payments = taken.rows["payment"].select("order_id", "payment_type_code", "callback_time", F.col("ts").alias("pay_ts"),
                                                event_time(F.col("ts")).alias("et"), F.col(FRESH).alias("new_payment"))
        details = taken.rows["detail"].withColumn("row_et", event_time(F.col("ts"))).withColumnRenamed(FRESH, "new_detail")
        paid = PF.paid_details(payments, details, details, before_ms, after_ms).where(F.col("new_payment") | F.col("new_detail"))
        append_batch(PF.payment_columns(paid, dic(details.sparkSession)), path, n)

    sides = {"payment": P.payment_src(changes, db).withColumnRenamed("payment_type", "payment_type_code").drop("user_id"),
             "detail": order_detail.drop("et", "row_et")}
    return band_sink(sides, handle, before_ms + after_ms, checkpoint, once)


def dwd_refund(changes: Changes, dic: Config, path: str, checkpoint: str, db: str = S.SOURCE_DB, once: bool = False,
               band_ms: int = S.ORDER_BAND_MS, unmatched: str | None = None, **sizes: int) -> StreamingQuery:
    """Refunds, to be read with ``read_upserts``; names are those the dictionary has when the batch runs."""
    def join(taken: Taken) -> DataFrame:
        return bands.join_refunds(taken.rows, band_ms, taken.before, taken.after)

    return upsert_sink(bands.refund_sides(changes, db), join, 2 * band_ms, path, checkpoint, once, unmatched=unmatched,
                       shape=lambda batch: PF.refund_columns(batch, dic(batch.sparkSession), "versions"), **sizes)


def dws_keyword(pages: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    return window_sink(PT.dws_keyword(pages), path, checkpoint, once=once)


def dws_traffic(pages: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    with disk_state(pages.sparkSession):
        return window_sink(SF.traffic_stream(pages), path, checkpoint, once=once)


def dws_home_detail(pages: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    with disk_state(pages.sparkSession):
        return window_sink(SF.home_detail_stream(pages), path, checkpoint, once=once)
