"""Projections of the business tables' changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse import settings as S
from rillhouse.functions.records import unpack_texts
from rillhouse.operators.clean import Changes, cdc_table, change_order, status_transition

# Columns read from each source table.
COMMENT_COLUMNS = ("id", "user_id", "nick_name", "sku_id", "spu_id", "order_id", "appraise",
                   "comment_txt", "create_time", "operate_time")
REFUND_COLUMNS = ("id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
                  "refund_reason_type", "refund_reason_txt", "refund_status")
PAYMENT_COLUMNS = ("user_id", "order_id", "payment_type", "callback_time")
ORDER_COLUMNS = ("id", "user_id", "province_id")
ACTIVITY_COLUMNS = ("order_detail_id", "activity_id", "activity_rule_id")
COUPON_COLUMNS = ("order_detail_id", "coupon_id")
# A detail's texts that no join needs; its original amount is computed from them.
PACKED = ("sku_id", "sku_name", "order_price", "sku_num", "create_time", "split_total_amount", "split_activity_amount",
          "split_coupon_amount")


def after(name: str) -> Column:
    return F.col("after")[name]


def after_columns(names: tuple[str, ...]) -> list[Column]:
    return [after(n).alias(n) for n in names]


def money(text: Column) -> Column:
    return text.try_cast("decimal(16,2)")


def comment_src(changes: Changes, db: str = S.SOURCE_DB) -> DataFrame:
    return cdc_table(changes, "comment_info", db).select(
        *after_columns(COMMENT_COLUMNS), F.col("ts_ms").alias("ts"))


def original_amount(sku_num: Column, order_price: Column) -> Column:
    return (money(sku_num) * money(order_price)).cast("string").alias("split_original_amount")


def order_detail_src(changes: Changes, db: str = S.SOURCE_DB) -> DataFrame:
    """Order details with their original amount, quantity times price."""
    return cdc_table(changes, "order_detail", db).select(
        *after_columns(("id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time")),
        original_amount(after("sku_num"), after("order_price")),
        *after_columns(("split_total_amount", "split_activity_amount", "split_coupon_amount")),
        F.col("ts_ms").alias("ts"), change_order().alias("seq"))


def unpack_details(rows: DataFrame) -> DataFrame:
    """Details whose ``PACKED`` columns travelled as one text, with these and their original amount."""
    return unpack_texts(rows, "packed", PACKED).withColumn(
        "split_original_amount", original_amount(F.col("sku_num"), F.col("order_price")))


def _with_order(changes: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return changes.select(*after_columns(names), F.col("ts_ms").alias("ts"), change_order().alias("seq"))


def order_info_src(changes: Changes, db: str = S.SOURCE_DB) -> DataFrame:
    return _with_order(cdc_table(changes, "order_info", db), ORDER_COLUMNS)


def order_cancel_src(changes: Changes, db: str = S.SOURCE_DB) -> DataFrame:
    """Orders at the moment they become cancelled."""
    updates = cdc_table(changes, "order_info", db, (S.OP_UPDATE,))
    return _with_order(status_transition(updates, "order_status", S.ORDER_CANCELLED, must_differ=True),
                       ORDER_COLUMNS)


def order_refund_src(changes: Changes, db: str = S.SOURCE_DB) -> DataFrame:
    """Orders at the moment they go into refund."""
    updates = cdc_table(changes, "order_info", db, (S.OP_UPDATE,))
    return _with_order(status_transition(updates, "order_status", S.ORDER_REFUNDED), ORDER_COLUMNS)


def order_activity_src(changes: Changes, db: str = S.SOURCE_DB) -> DataFrame:
    return _with_order(cdc_table(changes, "order_detail_activity", db), ACTIVITY_COLUMNS)


def order_coupon_src(changes: Changes, db: str = S.SOURCE_DB) -> DataFrame:
    return _with_order(cdc_table(changes, "order_detail_coupon", db), COUPON_COLUMNS)


def payment_src(changes: Changes, db: str = S.SOURCE_DB) -> DataFrame:
    """Payments at the moment they succeed."""
    updates = cdc_table(changes, "payment_info", db, (S.OP_UPDATE,))
    return status_transition(updates, "payment_status", S.PAYMENT_DONE).select(
        *after_columns(PAYMENT_COLUMNS), F.col("ts_ms").alias("ts"))


def refund_src(changes: Changes, db: str = S.SOURCE_DB) -> DataFrame:
    return cdc_table(changes, "order_refund_info", db).select(
        *after_columns(REFUND_COLUMNS), F.col("ts_ms").alias("ts"), change_order().alias("seq"))


def cart_add_src(changes: Changes, db: str = S.SOURCE_DB) -> DataFrame:
    """New cart rows and updates that raise the quantity, with the quantity added."""
    now = after("sku_num").try_cast("bigint")
    was = F.col("before")["sku_num"].try_cast("bigint")
    is_update = F.col("op") == S.OP_UPDATE
    added = cdc_table(changes, "cart_info", db).where(~is_update | (now > was))
    return added.select(
        *after_columns(("id", "user_id", "sku_id", "cart_price")),
        F.when(is_update, now - was).otherwise(now).alias("sku_num"),
        *after_columns(("sku_name", "create_time", "operate_time")),
        F.col("ts_ms").alias("ts"))
