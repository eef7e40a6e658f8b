from conftest import rows_of
from pyspark.sql import functions as F

from rillhouse.operators import facts, joins
from rillhouse.plans import facts as plans


def test_cart_add_counts_what_was_added(changes):
    df = changes(
        ("cart_info", "c", 1, None, {"id": "a", "sku_num": "3"}),
        ("cart_info", "u", 2, {"sku_num": "3"}, {"id": "b", "sku_num": "5"}),
        ("cart_info", "u", 3, {"sku_num": "5"}, {"id": "less", "sku_num": "2"}),
        ("cart_info", "u", 4, {}, {"id": "unknown", "sku_num": "2"}),
        ("cart_info", "u", 5, {"sku_num": "x"}, {"id": "bad", "sku_num": "2"}),
        ("cart_info", "d", 6, {"sku_num": "2"}, None),
        ("cart_info", "r", 7, None, {"id": "c", "sku_num": "1"}))
    assert rows_of(plans.dwd_cart_add(df), "id", "sku_num") == [("a", 3), ("b", 2), ("c", 1)]


def test_original_amount_is_decimal_text(changes):
    df = changes(("order_detail", "c", 1, None, {"id": "1", "sku_num": "2", "order_price": "10.50"}),
                 ("order_detail", "c", 1, None, {"id": "2", "sku_num": "two", "order_price": "1"}))
    assert rows_of(facts.order_detail_src(df), "id", "split_original_amount") == [("1", "21.0000"), ("2", None)]


def test_comment_needs_a_known_rating(changes, dic):
    df = changes(("comment_info", "c", 1, None, {"id": "a", "appraise": "1"}),
                 ("comment_info", "c", 1, None, {"id": "b", "appraise": "7"}))
    assert rows_of(plans.dwd_comment(df, dic), "id", "appraise_name") == [("a", "one")]


def order_feed(changes):
    return changes(
        ("order_info", "c", 1, None, {"id": "o1", "user_id": "u1", "province_id": "p", "order_status": "1001"}),
        ("order_info", "u", 9, {"order_status": "1001"},
         {"id": "o1", "user_id": "u1", "province_id": "q", "order_status": "1003"}),
        ("order_detail", "c", 2, None, {"id": "d1", "order_id": "o1", "sku_num": "1", "order_price": "1"}),
        ("order_detail", "u", 3, {}, {"id": "d1", "order_id": "o1", "sku_num": "4", "order_price": "1"}),
        ("order_detail", "c", 2, None, {"id": "d2", "order_id": "o1", "sku_num": "1", "order_price": "1"}),
        ("order_detail", "c", 2, None, {"id": "d3", "order_id": "none", "sku_num": "1", "order_price": "1"}),
        ("order_detail_activity", "c", 2, None, {"order_detail_id": "d1", "activity_id": "7", "activity_rule_id": "8"}),
        ("order_detail_coupon", "c", 2, None, {"order_detail_id": "d2", "coupon_id": "5"}))


def test_order_detail_keeps_unmatched_left_rows(changes):
    got = rows_of(plans.dwd_order_detail(order_feed(changes)), "id", "sku_num", "province_id", "activity_id", "coupon_id")
    assert got == [("d1", "4", "q", "7", None), ("d2", "1", "q", None, "5")]


def test_order_cancel_takes_cancelled_orders(changes):
    assert plans.dwd_order_cancel(order_feed(changes)).count() == 2
    none = changes(("order_detail", "c", 2, None, {"id": "d", "order_id": "o"}),
                   ("order_info", "u", 3, {"order_status": "1003"}, {"id": "o", "order_status": "1003"}))
    assert plans.dwd_order_cancel(none).count() == 0


def test_pay_suc_band_includes_its_ends(spark, changes, dic):
    t = 1_718_430_000_000
    pay = changes(("payment_info", "u", t, {"payment_status": "1601"},
                   {"order_id": "o", "payment_type": "2", "payment_status": "1602"}),
                  ("payment_info", "u", t, {"payment_status": "1601"},
                   {"order_id": "p", "payment_type": "9", "payment_status": "1602"}))
    offsets = {"first": -900_000, "last": 5_000, "before": -900_001, "after": 5_001, "mid": -1}
    rows = [(n, "o", t + o) for n, o in offsets.items()] + [("other", "p", t)]
    from rillhouse import schemas
    detail = spark.createDataFrame([(n, o, *[None] * 14, ts) for n, o, ts in rows], schemas.ORDER_DETAIL)
    got = rows_of(plans.dwd_pay_suc(pay, detail, dic), "order_detail_id", "payment_type_name")
    assert got == [("first", "two"), ("last", "two"), ("mid", "two"), ("other", None)]


def test_interval_join_equals_a_plain_range_join(spark):
    e = spark.range(400).select((F.col("id") % 3).alias("k"), "id", F.timestamp_millis(F.col("id") * 7919 % 100_000).alias("et"))
    r = spark.range(500).select((F.col("id") % 4).alias("k"), F.col("id").alias("rid"),
                                F.timestamp_millis(F.col("id") * 104729 % 100_000).alias("row_et"))
    got = joins.interval_join(e, r, "k", before_ms=700, after_ms=50)
    want = e.join(r, "k").where("row_et BETWEEN et - INTERVAL '0.7' SECOND AND et + INTERVAL '0.05' SECOND")
    assert rows_of(got, "id", "rid") == rows_of(want, "id", "rid") != []


def test_refund_looks_up_two_codes(changes, dic):
    df = changes(
        ("order_info", "u", 1, {"order_status": "1002"}, {"id": "o", "province_id": "p", "order_status": "1005"}),
        ("order_refund_info", "c", 2, None, {"id": "r1", "order_id": "o", "refund_type": "1", "refund_reason_type": "2"}),
        ("order_refund_info", "c", 2, None, {"id": "r2", "order_id": "o", "refund_type": "9", "refund_reason_type": None}),
        ("order_refund_info", "c", 2, None, {"id": "r3", "order_id": "x", "refund_type": "1"}))
    got = rows_of(plans.dwd_refund(df, dic), "id", "refund_type_name", "refund_reason_type_name", "province_id")
    assert got == [("r1", "one", "two", "p"), ("r2", None, None, "p")]
