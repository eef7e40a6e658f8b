"""Declared schemas of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()
TEXT_MAP = T.MapType(_TEXT, _TEXT)


def text_struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TEXT) for name in names])


# One change of a database row.
CHANGE = T.StructType([
    T.StructField("before", TEXT_MAP),
    T.StructField("after", TEXT_MAP),
    T.StructField("source", TEXT_MAP),
    T.StructField("op", _TEXT),
    T.StructField("ts_ms", T.LongType()),
])

# A change's place in the order of all changes.
CHANGE_ORDER = T.StructType([T.StructField(name, T.LongType()) for name in ("ts_ms", "file", "pos", "row")])

# One application log record. Maps keep fields that nobody declared.
APP_LOG = T.StructType([
    T.StructField("common", TEXT_MAP),
    T.StructField("page", TEXT_MAP),
    T.StructField("start", TEXT_MAP),
    T.StructField("displays", T.ArrayType(TEXT_MAP)),
    T.StructField("actions", T.ArrayType(TEXT_MAP)),
    T.StructField("err", TEXT_MAP),
    T.StructField("ts", T.LongType()),
])

# Fields of a log's maps that are numbers, by part; all others are texts.
LOG_NUMBERS = {
    "page": ("during_time",),
    "start": ("loading_time", "open_ad_ms", "open_ad_skip_ms"),
    "displays": ("pos_id", "pos_seq"),
    "actions": ("ts",),
    "err": ("error_code",),
}

# One page view, as the log split writes it.
PAGE_LOG = T.StructType([
    T.StructField("common", TEXT_MAP),
    T.StructField("page", TEXT_MAP),
    T.StructField("ts", T.LongType()),
])

# Page view with declared fields: a scan then reads only the fields a query uses.
PAGE_LOG_TYPED = T.StructType([
    T.StructField("common", text_struct("mid", "is_new", "vc", "ch", "ar", "sid")),
    T.StructField("page", T.StructType([
        *text_struct("page_id", "last_page_id", "item", "item_type").fields,
        T.StructField("during_time", T.LongType()),
    ])),
    T.StructField("ts", T.LongType()),
])

DIM_CONFIG_FIELDS = ("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key")
DWD_CONFIG_FIELDS = ("source_table", "source_type", "sink_table", "sink_columns")
DIM_CONFIG = text_struct(*DIM_CONFIG_FIELDS)
DWD_CONFIG = text_struct(*DWD_CONFIG_FIELDS)

BASE_DIC = T.StructType([
    T.StructField("dic_code", _TEXT, False),
    T.StructField("info", text_struct("dic_name")),
])

ORDER_DETAIL_FIELDS = (
    "id", "order_id", "user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
    "sku_id", "sku_name", "order_price", "sku_num", "create_time", "split_original_amount",
    "split_total_amount", "split_activity_amount", "split_coupon_amount",
)
ORDER_DETAIL = T.StructType([
    *text_struct(*ORDER_DETAIL_FIELDS).fields,
    T.StructField("ts", T.LongType()),
])

REFUND_FIELDS = (
    "id", "user_id", "province_id", "order_id", "sku_id", "refund_type_code", "refund_type_name", "refund_num",
    "refund_amount", "refund_reason_type_code", "refund_reason_type_name", "refund_reason_txt", "refund_status",
)
REFUND = T.StructType([
    *text_struct(*REFUND_FIELDS).fields,
    T.StructField("ts", T.LongType()),
])
