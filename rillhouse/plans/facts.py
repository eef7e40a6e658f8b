"""Business facts from the change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse import schemas, settings as S
from rillhouse.functions.records import pack_texts
from rillhouse.functions.times import event_time
from rillhouse.operators import facts as P
from rillhouse.operators.clean import Changes
from rillhouse.operators.joins import interval_join, lookup
from rillhouse.operators.skew import hot_keys, join_hot_split, splits_skew
from rillhouse.operators.upsert import upsert_latest
from rillhouse.plans import bands

ORDER_DETAIL_COLUMNS = (*schemas.ORDER_DETAIL_FIELDS, "ts")
COMMENT_COLUMNS = ("id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts")
REFUND_COLUMNS = (*schemas.REFUND_FIELDS, "ts")
PAYMENT_COLUMNS = ("order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
                   "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
                   "payment_type_name", "callback_time", "sku_num", "split_original_amount",
                   "split_activity_amount", "split_coupon_amount", "split_payment_amount", "ts")


def dwd_comment(changes: Changes, dic: DataFrame, db: str = S.SOURCE_DB) -> DataFrame:
    """Comments whose rating the dictionary knows."""
    return lookup(P.comment_src(changes, db), dic, "appraise", "appraise_name", "inner").select(*COMMENT_COLUMNS)


def dwd_cart_add(changes: Changes, db: str = S.SOURCE_DB) -> DataFrame:
    return P.cart_add_src(changes, db)


def _latest(df: DataFrame, key: str) -> DataFrame:
    return upsert_latest(df, [key], F.col("seq"), drop=("seq",))


def _details_with(changes: Changes, orders: DataFrame, db: str) -> DataFrame:
    """Latest details of the given orders, with activity and coupon where there are any.

    Every side is reduced to its latest row per key before it is joined, as the result keeps one
    row per detail anyway. What no join needs of a detail travels as one text. Only ``order_id`` can then repeat, on the detail side; its hot values are
    found in the source's column.
    """
    source = P.order_detail_src(changes, db).select("id", "order_id", pack_texts(*P.PACKED).alias("packed"), "ts", "seq")
    details = _latest(source, "id")
    orders = _latest(orders.drop("ts"), "id").select(F.col("id").alias("order_id"), "user_id", "province_id")
    activities = _latest(P.order_activity_src(changes, db).drop("ts"), "order_detail_id")
    coupons = _latest(P.order_coupon_src(changes, db).drop("ts"), "order_detail_id")
    # Three sides reduced by the detail's id already lie partitioned by it: these joins do not shuffle.
    complete = (details
                .join(activities.withColumnRenamed("order_detail_id", "id"), "id", "left")
                .join(coupons.withColumnRenamed("order_detail_id", "id"), "id", "left"))
    keys = P.order_detail_src(changes, db).select("order_id")
    return P.unpack_details(join_hot_split(complete, orders, "order_id", keys_from=keys)).select(*ORDER_DETAIL_COLUMNS)


def dwd_order_detail(changes: Changes, db: str = S.SOURCE_DB, band_ms: int | None = None) -> DataFrame:
    """Order details. With ``band_ms`` only changes at most so far apart belong together, as in the streaming job."""
    if band_ms is not None:
        return bands.latest(bands.order_details(changes, db, band_ms)).select(*ORDER_DETAIL_COLUMNS)
    return _details_with(changes, P.order_info_src(changes, db), db)


def dwd_order_cancel(changes: Changes, db: str = S.SOURCE_DB, wait_ms: int | None = None,
                     band_ms: int = S.ORDER_BAND_MS) -> DataFrame:
    """Details of cancelled orders. With ``wait_ms`` only of those cancelled so soon, as in the streaming job."""
    if wait_ms is not None:
        return bands.latest(bands.cancelled_details(changes, db, wait_ms, band_ms)).select(*ORDER_DETAIL_COLUMNS)
    return _details_with(changes, P.order_cancel_src(changes, db), db)


def dwd_pay_suc(changes: Changes, order_detail: DataFrame, dic: DataFrame, db: str = S.SOURCE_DB,
                before_ms: int = S.PAY_BEFORE_MS, after_ms: int = S.PAY_AFTER_MS) -> DataFrame:
    """Details of an order placed at most 15 minutes before its payment (or 5 seconds after).

    Where adaptive execution splits what is skewed and no order has very many details or payments, the sides meet on the order
    alone, by which ``dwd_order_detail`` leaves its rows partitioned.
    """
    payments = P.payment_src(changes, db).select(
        "order_id", F.col("payment_type").alias("payment_type_code"), "callback_time",
        F.col("ts").alias("pay_ts"), event_time(F.col("ts")).alias("et"))
    details = order_detail.select(
        *[c for c in order_detail.columns if c not in ("et", "row_et")],
        event_time(F.col("ts")).alias("row_et"))
    return payment_columns(paid_details(payments, details, P.order_detail_src(changes, db), before_ms, after_ms), dic)


def paid_details(payments: DataFrame, details: DataFrame, keys_from: DataFrame, before_ms: int, after_ms: int) -> DataFrame:
    """Details within the band of their payment; hot orders are looked for in ``keys_from`` and in the payments."""
    keys = keys_from.select("order_id").unionAll(payments.select("order_id"))
    spread = not splits_skew(details.sparkSession) or not hot_keys(keys, "order_id").isEmpty()
    return interval_join(payments, details, "order_id", before_ms=before_ms, after_ms=after_ms, spread=spread)


def payment_columns(paid: DataFrame, dic: DataFrame) -> DataFrame:
    """Paid details with the name of their payment's kind."""
    return lookup(paid, dic, "payment_type_code", "payment_type_name").drop("ts").withColumnsRenamed({
        "id": "order_detail_id", "split_total_amount": "split_payment_amount", "pay_ts": "ts",
    }).select(*PAYMENT_COLUMNS)


def dwd_refund(changes: Changes, dic: DataFrame, db: str = S.SOURCE_DB, band_ms: int | None = None) -> DataFrame:
    """Refund requests of refunded orders, with the names of their kind and reason. With ``band_ms`` only of orders that
    went into refund at most so far apart, as in the streaming job."""
    if band_ms is not None:
        return refund_columns(bands.latest(bands.refunds(changes, db, band_ms)), dic)
    orders = _latest(P.order_refund_src(changes, db), "id").select(F.col("id").alias("order_id"), "province_id")
    refunds = _latest(P.refund_src(changes, db), "id")
    keys = P.refund_src(changes, db).select("order_id")
    return refund_columns(join_hot_split(refunds, orders, "order_id", keys_from=keys), dic)


def refund_columns(joined: DataFrame, dic: DataFrame, *more: str) -> DataFrame:
    coded = joined.withColumnsRenamed({
        "refund_type": "refund_type_code", "refund_reason_type": "refund_reason_type_code"})
    named = lookup(coded, dic, "refund_type_code", "refund_type_name")
    return lookup(named, dic, "refund_reason_type_code", "refund_reason_type_name").select(*REFUND_COLUMNS, *more)
