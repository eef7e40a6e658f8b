"""Codes, names, formats and sizes that results depend on."""

# Change-record operation codes.
OP_CREATE = "c"
OP_READ = "r"
OP_UPDATE = "u"
OP_DELETE = "d"
UPSERT_OPS = ("c", "r", "u")

# Status codes of the business tables.
ORDER_CANCELLED = "1003"
ORDER_REFUNDED = "1005"
PAYMENT_DONE = "1602"

# Text formats of dates and times.
DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
PARTITION_DATE_FORMAT = "yyyyMMdd"

# Zone in which business date texts are written.
BUSINESS_ZONE = "+08:00"

# Topics of the split application log.
TOPIC_START = "dwd_traffic_start"
TOPIC_ERR = "dwd_traffic_err"
TOPIC_PAGE = "dwd_traffic_page"
TOPIC_ACTION = "dwd_traffic_action"
TOPIC_DISPLAY = "dwd_traffic_display"

# Topics of the business facts.
TOPIC_COMMENT = "dwd_interaction_comment_info"
TOPIC_CART_ADD = "dwd_trade_cart_add"
TOPIC_ORDER_DETAIL = "dwd_trade_order_detail"
TOPIC_ORDER_CANCEL = "dwd_trade_order_cancel"
TOPIC_PAY_SUC = "dwd_trade_order_payment_success"
TOPIC_REFUND = "dwd_trade_order_refund"

# Watermark delays, window sizes and time bands.
CHANGE_DELAY = "3 seconds"
CHANGE_DELAY_MS = 3_000
PAGE_DELAY = "5 seconds"
KEYWORD_WINDOW = "5 seconds"
TRAFFIC_WINDOW = "5 seconds"
HOME_DETAIL_WINDOW = "10 seconds"
SESSION_GAP_MS = 3_600_000
PAY_BEFORE_MS = 900_000
PAY_AFTER_MS = 5_000
ORDER_BAND_MS = 5_000
CANCEL_BAND_MS = 905_000

# Database whose changes the facts are built from; callers pass their own.
SOURCE_DB = "shop"
