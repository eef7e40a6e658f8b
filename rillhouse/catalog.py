"""Queries over the test tables, one per job and operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillhouse import schemas, settings as S
from rillhouse.functions import times as T
from rillhouse.functions.records import as_text_map, row_map
from rillhouse.operators import clean, dims, facts, joins, logs, upsert
from rillhouse.operators import visitors as V
from rillhouse.operators import windows as W
from rillhouse.plans import bands
from rillhouse.plans import facts as PF
from rillhouse.plans import routing as PR
from rillhouse.plans import traffic as PT
from rillhouse.session import release, shared_dir
from rillhouse.sinks import route_sink, to_snake_json
from rillhouse.sources import feeds
from rillhouse.sources import testfeeds as X
from rillhouse.streaming import jobs
from rillhouse.streaming.sinks import read_upserts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Position of a log record; breaks ties between equal times.
ORDER = ("ts", "event_id")
DETAIL_TABLES = ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return f(spark, sf_dir)
    QUERIES[f.__name__] = run
    return f


# --- jobs -------------------------------------------------------------------------------------

@query
def ods_ingest(spark, d):
    landed = PR.ods_ingest(X.raw_lines(spark, d, X.change_feed(spark, d, "order_info", "cart_info")))
    j = F.col("value")
    return landed.select("source_table", F.date_format("day", S.DATE_FORMAT).alias("day"),
                         F.get_json_object(j, "$.op").alias("op"),
                         F.get_json_object(j, "$.after.id").alias("id"),
                         F.get_json_object(j, "$.ts_ms").cast("bigint").alias("ts_ms"))


@query
def dim_sync(spark, d):
    feed = X.change_feed(spark, d, "user_info", "base_province", "base_dic_changes", "part_catalog", "cart_info")
    return _dim_columns(PR.dim_sync(feed, X.dim_config_changes(spark)))


def _dim_columns(rows: DataFrame) -> DataFrame:
    fields = ("id", "login_name", "name", "user_level", "birthday", "phone_num", "dic_code", "dic_name")
    return rows.select("sink_table", "row_key", *[F.col("data")[f].alias(f) for f in fields])


def _log_fields(rows: DataFrame) -> DataFrame:
    """Fields of all five topics of a split log."""
    v = F.col("value")

    def field(name: str):
        return F.coalesce(F.get_json_object(v, f"$.common.{name}"), F.get_json_object(v, f"$.{name}"))

    return rows.select(
        "topic", field("mid").alias("mid"), field("is_new").alias("is_new"), field("sid").alias("sid"),
        F.coalesce(F.get_json_object(v, "$.page.item"), F.get_json_object(v, "$.item")).alias("item"),
        F.get_json_object(v, "$.pos_id").alias("pos_id"), F.get_json_object(v, "$.action_id").alias("action_id"),
        F.get_json_object(v, "$.err.error_code").alias("error_code"),
        F.get_json_object(v, "$.ts").cast("bigint").alias("ts"))


@query
def dwd_base_log(spark, d):
    return _log_fields(PT.dwd_base_log(X.app_log(spark, d), ORDER))


@query
def dwd_base_db(spark, d):
    feed = X.change_feed(spark, d, "user_info", "base_province", "cart_info")
    v = F.col("value")
    return PR.dwd_base_db(feed, X.dwd_config_changes(spark)).select(
        "sink_table", F.size(F.json_object_keys(v)).alias("n_fields"),
        *[F.get_json_object(v, f"$.{f}").alias(f) for f in ("id", "login_name", "sku_num")])


@query
def dwd_comment(spark, d):
    return PF.dwd_comment(X.change_feed(spark, d, "comment_info", "cart_info"), X.base_dic(spark, d))


@query
def dwd_cart_add(spark, d):
    return PF.dwd_cart_add(X.change_feed(spark, d, "cart_info", "comment_info"))


@query
def dwd_order_detail(spark, d):
    return PF.dwd_order_detail(X.change_feed(spark, d, *DETAIL_TABLES))


@query
def dwd_order_cancel(spark, d):
    return PF.dwd_order_cancel(X.change_feed(spark, d, *DETAIL_TABLES))


@query
def dwd_pay_suc(spark, d):
    feed = X.change_feed(spark, d, *DETAIL_TABLES, "payment_info")
    return PF.dwd_pay_suc(feed, PF.dwd_order_detail(feed), X.base_dic(spark, d))


@query
def dwd_refund(spark, d):
    return PF.dwd_refund(X.change_feed(spark, d, "order_info", "order_refund_info"), X.base_dic(spark, d))


@query
def dws_keyword(spark, d):
    return PT.dws_keyword(X.page_log(spark, d))


@query
def dws_keyword_day(spark, d):
    return PT.dws_keyword(X.page_log(spark, d), "1 day")


@query
def dws_traffic(spark, d):
    return PT.dws_traffic(X.page_log(spark, d), order=ORDER)


@query
def dws_traffic_hour(spark, d):
    return PT.dws_traffic(X.page_log(spark, d), "1 hour", ORDER)


@query
def dws_home_detail(spark, d):
    return PT.dws_home_detail(X.page_log(spark, d))


@query
def dws_home_detail_day(spark, d):
    return PT.dws_home_detail(X.page_log(spark, d), "1 day")


# --- jobs as streaming queries ----------------------------------------------------------------

def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def _landed(spark: SparkSession, df: DataFrame) -> tuple[DataFrame, str]:
    """A stream over the rows, written to files first, and a folder for what the query writes."""
    folder = _folder(spark)
    df.write.parquet(f"{folder}/in")
    return spark.readStream.schema(df.schema).parquet(f"{folder}/in"), folder


def _restarted(spark: SparkSession, parts: list[DataFrame], start: Callable[[DataFrame, str, str], StreamingQuery]) -> str:
    """The folder of a query that is started once for each part of a feed, with the same checkpoint; ``start`` gets stream, folder and checkpoint."""
    folder = _folder(spark)
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(part.schema).parquet(f"{folder}/in")
        start(stream, folder, f"{folder}/checkpoint").awaitTermination()
    return folder


def _halves(lines: DataFrame, ts: Column, tombstones: int = 3) -> list[DataFrame]:
    """Lines up to the middle of their time and those after it, empty messages among both."""
    low, high = lines.agg(F.min(ts), F.max(ts)).first()
    middle = (low + high) // 2
    empty = lines.sparkSession.range(tombstones).select(F.lit(None).cast("string").alias("value"))
    return [lines.where(ts < middle).select("value").unionAll(empty), lines.where(ts >= middle).select("value").unionAll(empty)]


def _ods(spark: SparkSession, lines: DataFrame) -> str:
    """A folder into which the landing job has taken all lines, of a stream or written to files first."""
    stream, folder = (lines, _folder(spark)) if lines.isStreaming else _landed(spark, lines)
    jobs.ods_ingest(stream, f"{folder}/ods", f"{folder}/ods-checkpoint", once=True).awaitTermination()
    release(spark)
    return f"{folder}/ods"


def _landed_streams(spark: SparkSession, d: str, *names: str) -> tuple[Callable[[str], DataFrame], str]:
    """The landed changes of the named tables as one stream each, closing rows included, and a folder for results."""
    closing, _ = _landed(spark, X.closing_changes(spark, *names))
    feed = X.change_feed(spark, X.Streams(d), *names).unionByName(closing)
    ods = _ods(spark, X.json_lines(feed))
    return lambda table: feeds.stream_ods(spark, ods, table), ods.rsplit("/", 1)[0]


def _window_rows(spark: SparkSession, folder: str, measures: str) -> DataFrame:
    """Windows that a query wrote; the closing row's own window stays open."""
    return spark.read.schema(f"stt string, edt string, cur_date string, {measures}").json(f"{folder}/out/batches/*")


@query
def dwd_order_detail_landed(spark, d):
    """Order details from the landed feed, of which only the four tables' folders are read; lines that are no JSON stay out."""
    tables = X.Streams(d)
    lines = X.raw_lines(spark, tables, X.change_feed(spark, tables, *DETAIL_TABLES, "payment_info", "cart_info"))
    return PF.dwd_order_detail(feeds.ods_tables(spark, _ods(spark, lines)))


@query
def read_ods_days(spark, d):
    """Cart changes of two days from the landed feed."""
    lines = X.json_lines(X.change_feed(spark, d, "cart_info", "order_info"))
    days = X.table(spark, d, "events").agg(F.date_format(F.min("ts"), S.DATE_FORMAT), F.date_format(F.date_add(F.min("ts"), 1), S.DATE_FORMAT)).first()
    rows = feeds.read_ods(spark, _ods(spark, lines), ("cart_info",), tuple(days))
    return rows.select(F.col("source")["table"].alias("source_table"), "op", F.col("after")["id"].alias("id"), "ts_ms")


@query
def dwd_order_detail_band(spark, d):
    """Order details whose order change is at most five seconds away, as the streaming job joins them by default."""
    return PF.dwd_order_detail(X.change_feed(spark, d, *DETAIL_TABLES), band_ms=S.ORDER_BAND_MS)


@query
def order_detail_unmatched(spark, d):
    """Detail changes without an order change in those five seconds."""
    rows = bands.order_details(X.change_feed(spark, d, *DETAIL_TABLES), band_ms=S.ORDER_BAND_MS)
    return bands.unmatched(rows).select("id", "order_id", "split_coupon_amount", "ts")


@query
def stream_ods_ingest(spark, d):
    lines = X.raw_lines(spark, d, X.change_feed(spark, d, "order_info", "cart_info"))
    rows = spark.read.schema(feeds.ODS).parquet(_ods(spark, lines))
    j = F.col("value")
    return rows.select("source_table", F.date_format("day", S.DATE_FORMAT).alias("day"), F.get_json_object(j, "$.op").alias("op"),
                       F.get_json_object(j, "$.after.id").alias("id"), F.get_json_object(j, "$.ts_ms").cast("bigint").alias("ts_ms"))


@query
def stream_dwd_order_detail(spark, d):
    """Order details as a streaming query over the landed feed, in a band that holds all of an order's changes, read back by key."""
    changes, folder = _landed_streams(spark, d, *DETAIL_TABLES)
    jobs.dwd_order_detail(changes, f"{folder}/out", f"{folder}/checkpoint", once=True, band_ms=10_000,
                          unmatched=f"{folder}/unmatched").awaitTermination()
    release(spark)
    return read_upserts(spark, f"{folder}/out", schemas.ORDER_DETAIL).where(F.col("id") != X.LAST)


@query
def stream_dwd_order_cancel(spark, d):
    changes, folder = _landed_streams(spark, d, *DETAIL_TABLES)
    jobs.dwd_order_cancel(changes, f"{folder}/out", f"{folder}/checkpoint", once=True, band_ms=10_000).awaitTermination()
    release(spark)
    return read_upserts(spark, f"{folder}/out", schemas.ORDER_DETAIL).where(F.col("id") != X.LAST)


@query
def stream_dwd_pay_suc(spark, d):
    """Payments as a streaming query over the landed feed and the order details as a file stream, names from a table read per batch."""
    changes, folder = _landed_streams(spark, d, "payment_info")
    PF.dwd_order_detail(X.change_feed(spark, d, *DETAIL_TABLES)).write.option("compression", "zstd").parquet(f"{folder}/details")
    release(spark)
    details = feeds.read_order_detail(spark, f"{folder}/details", streaming=True)
    jobs.dwd_pay_suc(changes, details, lambda s: X.base_dic(s, d), f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out/batches/*")


@query
def stream_dwd_refund(spark, d):
    """Refunds come a minute after their order goes into refund, so in a band of two minutes."""
    changes, folder = _landed_streams(spark, d, "order_info", "order_refund_info")
    jobs.dwd_refund(changes, lambda s: X.base_dic(s, d), f"{folder}/out", f"{folder}/checkpoint", once=True, band_ms=120_000,
                    unmatched=f"{folder}/unmatched").awaitTermination()
    release(spark)
    return read_upserts(spark, f"{folder}/out", schemas.REFUND).where(F.col("id") != X.LAST)


@query
def stream_dwd_comment(spark, d):
    stream, folder = _landed(spark, X.change_feed(spark, d, "comment_info", "cart_info"))
    jobs.dwd_comment(stream, lambda s: X.base_dic(s, d), f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out/batches/*")


@query
def stream_dwd_cart_add(spark, d):
    stream, folder = _landed(spark, X.change_feed(spark, d, "cart_info", "comment_info"))
    jobs.dwd_cart_add(stream, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query
def stream_dwd_base_db(spark, d):
    stream, folder = _landed(spark, X.change_feed(spark, d, "user_info", "base_province", "cart_info"))
    jobs.dwd_base_db(stream, X.dwd_config_changes, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    v = F.col("value")
    return spark.read.text(f"{folder}/out/batches").select(
        "sink_table", F.size(F.json_object_keys(v)).alias("n_fields"),
        *[F.get_json_object(v, f"$.{f}").alias(f) for f in ("id", "login_name", "sku_num")])


@query
def stream_dwd_base_log(spark, d):
    """The log split as a query that is stopped in the middle of the logs' time and started again; raw lines, tombstones among them."""
    lines = X.app_log(spark, d).drop("event_id")
    lines = lines.select("ts", F.to_json(F.struct(*lines.columns)).alias("value"))

    def start(stream, folder, checkpoint):
        messages = feeds.drop_tombstones(stream)
        return jobs.dwd_base_log(messages, f"{folder}/out", f"{folder}/state", checkpoint, once=True)

    folder = _restarted(spark, _halves(lines, F.col("ts")), start)
    return _log_fields(spark.read.text(f"{folder}/out/batches").select("topic", "value"))


@query
def stream_restart_dws_keyword(spark, d):
    """Keyword windows of a query that is stopped in the middle and started again.

    Empty messages come in both halves. The second one repeats rows of five days and more before the middle: their windows are closed.
    """
    views = X.page_log(spark, d).drop("event_id")
    views = views.unionByName(X.closing_view(views))
    closing = views.agg(F.max("ts")).first()[0]
    lines = views.select("ts", F.to_json(F.struct(*views.columns)).alias("value"))
    first, second = _halves(lines.where(F.col("ts") < closing), F.col("ts"))
    middle = F.get_json_object("value", "$.ts").cast("bigint")
    latest = first.agg(F.max(middle)).first()[0]
    late = first.where(middle < latest - 5 * 86_400_000)
    second = second.unionAll(late).unionAll(lines.where(F.col("ts") == closing).select("value"))

    def start(stream, folder, checkpoint):
        return jobs.dws_keyword(feeds.read_page_log(feeds.drop_tombstones(stream), typed=True, delay=None), f"{folder}/out", checkpoint, once=True)

    return _window_rows(spark, _restarted(spark, [first, second], start), "keyword string, keyword_count bigint")


@query
def stream_dws_traffic(spark, d):
    """The traffic windows as a streaming query; a row a year later closes all windows."""
    views = X.page_log(spark, d).drop("event_id")
    stream, folder = _landed(spark, views.unionByName(X.closing_view(views)))
    jobs.dws_traffic(stream, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    measures = "vc string, ch string, ar string, is_new string, uv_ct bigint, sv_ct bigint, pv_ct bigint, dur_sum bigint"
    return _window_rows(spark, folder, measures)


@query
def stream_dws_home_detail(spark, d):
    """Home and detail visitors; the closing view is one of the home page."""
    views = X.page_log(spark, d).drop("event_id")
    closing = X.closing_view(views).withColumn("page", F.col("page").withField("page_id", F.lit(W.HOME)))
    stream, folder = _landed(spark, views.unionByName(closing))
    jobs.dws_home_detail(stream, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return _window_rows(spark, folder, "home_uv_ct bigint, good_detail_uv_ct bigint")


@query
def chain_log_to_traffic(spark, d):
    """Raw lines cleaned, repaired and split by topic into files; page views read back from there and summed by window."""
    logs_in = clean.clean_json(X.raw_lines(spark, d, X.app_log(spark, d).drop("event_id")), schemas.APP_LOG)
    folder = _folder(spark)
    route_sink(PT.dwd_base_log(logs_in), f"{folder}/log", "topic", "text")
    views = feeds.read_page_log(feeds.read_json_lines(spark, f"{folder}/log/topic={S.TOPIC_PAGE}"), typed=True)
    return PT.dws_traffic(views)


@query
def stream_dim_sync(spark, d):
    """The dimensions kept current by a streaming query, then read back."""
    feed = X.change_feed(spark, d, "user_info", "base_province", "base_dic_changes", "part_catalog")
    stream, folder = _landed(spark, feed)
    jobs.dim_sync(stream, X.dim_config_changes, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return _dim_columns(jobs.read_dims(spark, f"{folder}/out", X.dim_config_changes))


# --- sources and cleaning ---------------------------------------------------------------------

@query
def read_cdc(spark, d):
    rows = feeds.read_cdc(X.raw_lines(spark, d, X.change_feed(spark, d, "payment_info")))
    return rows.select(F.col("source")["table"].alias("source_table"), "op", "ts_ms",
                       F.date_format("et", S.DATETIME_FORMAT).alias("et"),
                       F.col("before")["payment_status"].alias("was"), F.col("after")["payment_status"].alias("is"),
                       F.col("after")["order_id"].alias("order_id"))


@query
def read_page_log(spark, d):
    pages = feeds.read_page_log(X.raw_lines(spark, d, X.page_log(spark, d).drop("event_id")))
    page, common = F.col("page"), F.col("common")
    return pages.select("ts", F.date_format("et", S.DATETIME_FORMAT).alias("et"), common["mid"].alias("mid"),
                        page["page_id"].alias("page_id"), page["item"].alias("item"),
                        page["during_time"].cast("bigint").alias("during_time"))


@query
def snapshot_changes(spark, d):
    """A snapshot of the customers, then their changes."""
    snapshot = feeds.snapshot_changes(X.table(spark, d, "customer"), "user_info", X.EPOCH_MS)
    both = feeds.changes_from(X.change_feed(spark, d, "user_info"), "initial", snapshot)
    return both.select("op", "ts_ms", F.coalesce(F.col("after")["id"], F.col("after")["c_custkey"],
                                                 F.col("before")["id"]).alias("id"),
                       F.coalesce(F.col("after")["c_name"], F.col("after")["name"]).alias("name"))


@query
def clean_json(spark, d):
    rows = clean.clean_json(X.raw_lines(spark, d, X.app_log(spark, d).drop("event_id")), schemas.APP_LOG)
    return rows.select(F.col("common")["mid"].alias("mid"), F.col("common")["sid"].alias("sid"),
                       F.col("page")["page_id"].alias("page_id"), F.size("displays").alias("n_displays"),
                       F.col("err")["error_code"].alias("error_code"), "ts")


@query
def clean_cdc(spark, d):
    rows = clean.clean_cdc(X.raw_lines(spark, d, X.change_feed(spark, d, "cart_info", "user_info")))
    return rows.select(F.col("source")["table"].alias("source_table"), "op", F.col("after")["id"].alias("id"), "ts_ms")


@query
def cdc_table(spark, d):
    feed = X.change_feed(spark, d, "cart_info", "order_info", "user_info")
    return clean.cdc_table(feed, "cart_info").select("op", F.col("after")["id"].alias("id"), "ts_ms")


def _transition(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("after")["id"].alias("id"), F.col("after")["order_status"].alias("order_status"), "ts_ms")


@query
def status_cancelled(spark, d):
    return _transition(clean.status_transition(X.change_feed(spark, d, "order_info"), "order_status",
                                               S.ORDER_CANCELLED, must_differ=True))


@query
def status_refunded(spark, d):
    return _transition(clean.status_transition(X.change_feed(spark, d, "order_info"), "order_status",
                                               S.ORDER_REFUNDED))


@query
def status_paid(spark, d):
    return facts.payment_src(X.change_feed(spark, d, "order_info", "payment_info"))


@query
def effective_row(spark, d):
    rows = clean.effective_row(X.change_feed(spark, d, "user_info"))
    return rows.select("op", "ts_ms", *[F.col("data")[f].alias(f) for f in ("id", "name", "login_name")])


@query
def prune_columns(spark, d):
    """Each customer row reduced to the columns its market segment lists."""
    rows = X.table(spark, d, "customer")
    listed = F.when(F.col("c_mktsegment") == "BUILDING", "c_custkey,c_name").otherwise("c_custkey,c_acctbal")
    rows = rows.select(row_map(rows).alias("data"), listed.alias("sink_columns"))
    return clean.prune_columns(rows, keep=("c_nationkey",)).select(
        F.size("data").alias("n"), *[F.col("data")[f].alias(f) for f in ("c_custkey", "c_name", "c_nationkey")])


# --- facts ------------------------------------------------------------------------------------

@query
def comment_src(spark, d):
    return facts.comment_src(X.change_feed(spark, d, "comment_info"))


@query
def order_detail_src(spark, d):
    return facts.order_detail_src(X.change_feed(spark, d, "order_detail")).drop("seq")


@query
def order_info_src(spark, d):
    return facts.order_info_src(X.change_feed(spark, d, "order_info")).drop("seq")


@query
def order_activity_src(spark, d):
    return facts.order_activity_src(X.change_feed(spark, d, "order_detail_activity")).drop("seq")


@query
def order_coupon_src(spark, d):
    return facts.order_coupon_src(X.change_feed(spark, d, "order_detail_coupon")).drop("seq")


@query
def refund_src(spark, d):
    return facts.refund_src(X.change_feed(spark, d, "order_refund_info")).drop("seq")


@query
def lookup_left(spark, d):
    """Payments with the name of their kind, or without one."""
    paid = facts.payment_src(X.change_feed(spark, d, "payment_info"))
    return joins.lookup(paid, X.base_dic(spark, d), "payment_type", "payment_type_name")


@query
def interval_join(spark, d):
    """Purchases with the views of the same user in the 15 minutes before (5 seconds after)."""
    events = X.table(spark, d, "events").select(
        F.col("event_id"), "user_id", "event_type", F.timestamp_millis(X.millis("ts")).alias("et"))
    bought = events.where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id", "et")
    seen = events.where("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("et").alias("row_et"))
    return joins.interval_join(bought, seen, "user_id").select("user_id", "purchase_id", "view_id")


@query
def route_changes(spark, d):
    feed = X.change_feed(spark, d, "user_info", "base_province", "part_catalog")
    routed = joins.route_changes(feed, PR.dim_config(X.dim_config_changes(spark)))
    return routed.select("sink_table", "op", "ts_ms", F.col("data")[F.col("sink_row_key")].alias("row_key"))


# --- keyed state ------------------------------------------------------------------------------

@query
def upsert_latest(spark, d):
    """Last event of each user."""
    events = X.table(spark, d, "events").select("user_id", "event_id", "event_type", "value", X.millis("ts").alias("ts"))
    return upsert.upsert_latest(events, ["user_id"], F.struct("ts", "event_id"))


@query
def change_order(spark, d):
    """Three changes of each order at one time: two log files, and two rows of one event in the later file."""
    o = X.table(spark, d, "orders")

    def change(file: str, pos: int, row: int, name: str) -> DataFrame:
        after = X.texts(id="o_orderkey", user_id="o_custkey", province_id=F.lit(name))
        feed = X.changes(o, "order_info", X.change("u", X.order_clock("o_orderkey"), pos, before=after, after=after))
        return feed.withColumn("source", F.map_concat("source", X.texts(file=F.lit(file), row=F.lit(row))))

    feed = change("bin.000010", 4, 0, "first row").unionByName(change("bin.000010", 4, 1, "last")).unionByName(
        change("bin.000009", 9000, 7, "old file")).unionByName(change("bin.000010", 3, 9, "before"))
    return upsert.upsert_latest(facts.order_info_src(feed), ["id"], F.col("seq"), drop=("seq",))


@query
def latest_config(spark, d):
    """Each customer's orders as changes of one configuration row; finished orders delete it."""
    o = X.table(spark, d, "orders")
    op = F.when(F.col("o_orderstatus") == "F", "d").when(F.col("o_orderstatus") == "P", "u").otherwise("c")
    row = X.texts(source_table="o_custkey", sink_table="o_orderkey", sink_columns="o_orderpriority",
                  sink_family=F.lit("info"), sink_row_key=F.lit("id"))
    feed = X.changes(o, "table_process_dim", X.change(
        op, X.order_clock("o_orderkey"), before=F.when(op != "c", row), after=F.when(op != "d", row)))
    return PR.dim_config(feed)


@query
def dim_merge(spark, d):
    config = PR.dim_config(X.dim_config_changes(spark))
    rows = dims.dim_merge(joins.route_changes(X.change_feed(spark, d, "user_info"), config))
    return dims.dim_table(rows, "dim_user_info", ["id", "login_name", "name", "user_level", "birthday"])


@query
def dim_config_reset(spark, d):
    """Users merged without regard to resets, which come when half the keys are written."""
    config = PR.dim_config(X.dim_config_changes(spark))
    cells = dims.dim_cells(joins.route_changes(X.change_feed(spark, d, "user_info"), config))
    half = X.table(spark, d, "customer").agg((F.max("c_custkey") * 5 + F.lit(X.EPOCH_MS)).alias("reset_ts"))
    resets = half.select(F.lit("dim_user_info").alias("sink_table"), "reset_ts")
    rows = dims.dim_rows(dims.dim_config_reset(cells, resets))
    return dims.dim_table(rows, "dim_user_info", ["id", "login_name", "name"])


# --- visitors and windows ---------------------------------------------------------------------

@query
def new_visitor_repair(spark, d):
    return V.new_visitor_repair(X.app_log(spark, d), ORDER).select(
        "event_id", F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"), "ts")


@query
def daily_visitors(spark, d):
    return V.daily_visitors(X.page_log(spark, d), W.traffic_dims(), ORDER)


@query
def session_starts(spark, d):
    return V.session_starts(X.page_log(spark, d), W.traffic_dims(), ORDER)


@query
def home_detail_visitors(spark, d):
    return V.home_detail_visitors(W.home_detail_pages(X.page_log(spark, d)))


@query
def home_detail_pages(spark, d):
    return W.home_detail_pages(X.page_log(spark, d)).select("event_id", F.col("page")["page_id"].alias("page_id"), "ts")


@query
def search_pages(spark, d):
    return W.search_pages(X.page_log(spark, d))


@query
def kw_split(spark, d):
    """Words of whole documents; one row per different word and document."""
    docs = X.table(spark, d, "documents").select("doc_id", F.col("text").alias("keywords"))
    return W.split_keywords(docs).groupBy("doc_id").agg(
        F.count("keyword").alias("n_words"), F.min("keyword").alias("first_word"), F.max("keyword").alias("last_word"))


@query
def with_window_text(spark, d):
    """Events per ten seconds."""
    events = X.table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("et"))
    return W.with_window_text(events.groupBy(W.tumble("10 seconds")).agg(F.count(F.lit(1)).alias("n")))


# --- log split --------------------------------------------------------------------------------

@query
def log_start(spark, d):
    return logs.log_start(X.app_log(spark, d)).select("event_id", F.col("start")["entry"].alias("entry"), "ts")


@query
def log_display(spark, d):
    rows = logs.log_display(X.app_log(spark, d))
    return rows.select(*[F.col("display")[f].alias(f) for f in ("mid", "item", "pos_id", "is_new")], "ts")


@query
def log_action(spark, d):
    rows = logs.log_action(X.app_log(spark, d))
    return rows.select(*[F.col("action")[f].alias(f) for f in ("mid", "item", "action_id", "sid")])


@query
def log_err(spark, d):
    rows = logs.log_err(X.app_log(spark, d))
    return rows.select("event_id", F.col("err")["error_code"].alias("error_code"),
                       F.col("page")["page_id"].alias("page_id"), "ts")


@query
def log_page(spark, d):
    rows = logs.log_page(X.app_log(spark, d))
    return rows.select("event_id", F.col("page")["page_id"].alias("page_id"), "ts", F.size(as_text_map(rows, "common")).alias("n"))


# --- texts ------------------------------------------------------------------------------------

@query
def snake_json(spark, d):
    """Window rows in camelCase as snake_case JSON."""
    rows = PT.dws_home_detail(X.page_log(spark, d)).withColumnsRenamed(
        {"cur_date": "curDate", "home_uv_ct": "homeUvCt", "good_detail_uv_ct": "goodDetailUvCt"})
    return to_snake_json(rows.withColumn("ts", F.lit(1)), transient=("ts",))


@query
def time_texts(spark, d):
    """Times of every event in all the text forms, and back."""
    e = X.table(spark, d, "events").withColumn("ms", X.millis("ts"))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return e.select(
        "event_id", T.ms_to_date(F.col("ms")).alias("day"), T.ms_to_datetime(F.col("ms")).alias("at"),
        T.ms_to_partition_date(F.col("ms")).alias("part"),
        T.datetime_to_ms(T.ms_to_datetime(F.col("ms"))).alias("back"),
        T.date_to_ms(T.ms_to_date(F.col("ms"))).alias("day_back"),
        T.epoch_day_text(F.floor(F.col("ms") / 86_400_000)).alias("date_text"),
        T.time_text(micros % 86_400_000_000).alias("time_text"), T.datetime_text(F.col("ts")).alias("datetime_text"),
        T.timestamp_text(F.col("ts"), "Asia/Shanghai").alias("timestamp_text"))
