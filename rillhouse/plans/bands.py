"""Business facts whose sides belong together only within a band of event time.

Static plans, streaming jobs and their tests share these joins; a band is one argument everywhere. Every
combination of changes within the band is one row, ``latest`` keeps those that count. Rows of the left side for which
no right row of an inner join lies in the band are kept too, as ``matched = false``: they are not part of the fact, and a
job can write them to a folder of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse import schemas, settings as S
from rillhouse.functions.records import pack_texts
from rillhouse.operators import facts as P
from rillhouse.operators.bands import band_join, due, side, timed, versions
from rillhouse.operators.clean import Changes
from rillhouse.operators.upsert import upsert_latest

# Order rows are repeated this often, so that the details of one order reach as many tasks.
SALTS = 8


DETAIL_RIGHTS = ("v_order", "v_activity", "v_coupon")


def detail_sides(changes: Changes, orders: DataFrame, db: str) -> dict[str, DataFrame]:
    """What joins of details need of each side, with its time and its place in the change order."""
    details = P.order_detail_src(changes, db).select("id", "order_id", pack_texts(*P.PACKED).alias("packed"), "ts", "seq")
    return {"detail": details, "order": orders, "activity": P.order_activity_src(changes, db), "coupon": P.order_coupon_src(changes, db)}


def join_details(sides: dict[str, DataFrame], before_ms: int, after_ms: int, known: int = 0, watermark: int | None = None) -> DataFrame:
    """Details with what lies in their band; with a ``watermark`` only what is due, see there."""
    details = timed(sides["detail"].withColumnRenamed("seq", "v_detail"), "et")
    order_side = side(sides["order"], "order_id", "v_order", "user_id", "province_id")
    activity_side = side(sides["activity"], "id", "v_activity", "activity_id", "activity_rule_id")
    coupon_side = side(sides["coupon"], "id", "v_coupon", "coupon_id")
    rows = band_join(details, order_side, "order_id", before_ms, after_ms, "left", salts=SALTS)
    rows = band_join(rows, activity_side, "id", before_ms, after_ms, "left")
    rows = band_join(rows, coupon_side, "id", before_ms, after_ms, "left")
    rows = rows if watermark is None else due(rows, DETAIL_RIGHTS, after_ms, known, watermark)
    return P.unpack_details(rows).select(*schemas.ORDER_DETAIL.names, versions("v_detail", *DETAIL_RIGHTS),
                                         F.col("v_order").isNotNull().alias("matched"))


def order_details(changes: Changes, db: str = S.SOURCE_DB, band_ms: int = S.ORDER_BAND_MS) -> DataFrame:
    """Details with the order, activity and coupon changes at most ``band_ms`` before or after."""
    return join_details(detail_sides(changes, P.order_info_src(changes, db), db), band_ms, band_ms)


def cancelled_details(changes: Changes, db: str = S.SOURCE_DB, wait_ms: int = S.CANCEL_BAND_MS,
                      band_ms: int = S.ORDER_BAND_MS) -> DataFrame:
    """Details of orders cancelled at most ``wait_ms`` after the detail, or ``band_ms`` before."""
    return join_details(detail_sides(changes, P.order_cancel_src(changes, db), db), band_ms, wait_ms)


def refund_sides(changes: Changes, db: str) -> dict[str, DataFrame]:
    return {"refund": P.refund_src(changes, db), "order": P.order_refund_src(changes, db)}


def join_refunds(sides: dict[str, DataFrame], band_ms: int, known: int = 0, watermark: int | None = None) -> DataFrame:
    """Refund requests with what lies in their band; with a ``watermark`` only what is due, see there."""
    requests = timed(sides["refund"].withColumnRenamed("seq", "v_refund"), "et")
    orders = side(sides["order"], "order_id", "v_order", "province_id")
    rows = band_join(requests, orders, "order_id", band_ms, band_ms, "left", salts=SALTS)
    rows = rows if watermark is None else due(rows, ("v_order",), band_ms, known, watermark)
    return rows.select(*P.REFUND_COLUMNS, "ts", "province_id", versions("v_refund", "v_order"), F.col("v_order").isNotNull().alias("matched"))


def refunds(changes: Changes, db: str = S.SOURCE_DB, band_ms: int = S.ORDER_BAND_MS) -> DataFrame:
    """Refund requests with the order's move into refund at most ``band_ms`` before or after; kinds and reasons as codes."""
    return join_refunds(refund_sides(changes, db), band_ms)


def latest(rows: DataFrame, key: str = "id") -> DataFrame:
    """Of all matched rows of a key the latest, by time and then by each side's place in the change order."""
    return upsert_latest(rows.where("matched"), [key], F.struct("ts", "versions"), drop=("versions", "matched"))


def unmatched(rows: DataFrame) -> DataFrame:
    """Left rows without any right row in the band."""
    return rows.where(~F.col("matched")).drop("versions", "matched")
