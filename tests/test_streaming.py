"""Streams against the static form of the same job, over files that arrive one by one."""

import json

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F
from test_dims import CONFIG, config_feed
from test_visitors import DAY, HOUR, ORDER, T0, random_pages

from rillhouse import schemas
from rillhouse.operators.clean import clean_json
from rillhouse.operators.visitors import session_starts
from rillhouse.plans import bands
from rillhouse.plans import facts as PF
from rillhouse.plans import routing as PR
from rillhouse.plans import traffic as PT
from rillhouse.sources import testfeeds as X
from rillhouse.sources.feeds import read_json_stream, read_order_detail
from rillhouse.streaming import jobs
from rillhouse.streaming.sinks import append_sink, read_upserts
from rillhouse.streaming.visitors import daily_row, first_events_stream, session_row

FAR = T0 + 400 * DAY


@pytest.fixture
def feed(spark, tmp_path):
    """A folder that files are added to, and a stream over it."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")

    class Feed:
        path, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")

        def add(self, *frames):
            for f in frames:
                f.coalesce(1).write.mode("append").parquet(self.path)
                self.schema = f.schema

        def stream(self):
            return spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)

        def run(self, job, *args, **kwargs):
            query = job(self.stream(), *args, checkpoint=self.checkpoint, once=True, **kwargs)
            query.awaitTermination()

    return Feed()


def windows(spark, path):
    return spark.read.json(f"{path}/batches").where("stt < '2025-01-01'").drop("batch")


def same(got, want):
    assert rows_of(got, *sorted(want.columns)) == rows_of(want, *sorted(want.columns)) != []


def paged(pages, n):
    """Random page views in ``n`` parts, all of them, and a late row that closes all windows."""
    rows, df = random_pages(pages, 240)
    parts = [df.where((F.col("id") >= i * 240 // n) & (F.col("id") < (i + 1) * 240 // n)) for i in range(n)]
    return parts, df, pages(("late", "late", "0", "home", FAR))


def test_traffic_stream_with_restart(spark, feed, pages):
    parts, df, late = paged(pages, 3)
    feed.add(*parts[:2])
    feed.run(jobs.dws_traffic, feed.out)
    feed.add(parts[2], late)
    feed.run(jobs.dws_traffic, feed.out)
    same(windows(spark, feed.out), PT.dws_traffic(df, order=ORDER))


def test_home_detail_stream(spark, feed, pages):
    parts, df, late = paged(pages, 2)
    feed.add(*parts, late)
    feed.run(jobs.dws_home_detail, feed.out)
    same(windows(spark, feed.out), PT.dws_home_detail(df))


def test_keyword_stream(spark, feed):
    log = X.page_log(spark, SMALL).drop("event_id")
    late = log.where("page.item_type = 'keyword' AND page.item IS NOT NULL").limit(1).withColumn("ts", F.lit(FAR))
    half = T0 + 15 * DAY
    feed.add(log.where(F.col("ts") < half), log.where(F.col("ts") >= half), late)
    feed.run(jobs.dws_keyword, feed.out)
    same(windows(spark, feed.out), PT.dws_keyword(log))


def test_late_page_views_are_dropped_by_closed_windows(spark, feed, pages):
    feed.add(pages(("a", "a", "0", "home", T0)), pages(("b", "b", "0", "home", T0 + HOUR)),
             pages(("d", "d", "0", "home", T0 + 2 * HOUR)),
             pages(("c", "c", "0", "home", T0 + 1)), pages(("late", "late", "0", "home", FAR)))
    feed.run(jobs.dws_home_detail, feed.out)
    assert rows_of(windows(spark, feed.out), "stt", "home_uv_ct") == \
        [("2024-01-01 00:00:00", 1), ("2024-01-01 01:00:00", 1), ("2024-01-01 02:00:00", 1)]


def detail(i, order, ts, **more):
    return ("order_detail", "c", ts, None, {"id": i, "order_id": order, "sku_num": "2", "order_price": "3", **more})


def order(i, ts, op="c", before=None, status="1001"):
    return ("order_info", op, ts, before, {"id": i, "user_id": f"u{i}", "province_id": "p", "order_status": status})


def extras(i, ts):
    return [("order_detail_activity", "c", ts, None, {"order_detail_id": i, "activity_id": "A", "activity_rule_id": "R"}),
            ("order_detail_coupon", "c", ts, None, {"order_detail_id": i, "coupon_id": "C"})]


def test_order_detail_stream(spark, feed, changes):
    first = changes(order("1", T0), detail("a", "1", T0 + 1000), detail("b", "1", T0 + 4000), *extras("a", T0 + 2000),
                    detail("x", "none", T0))
    later = changes(detail("a", "1", T0 + 3000, sku_num="5"), order("2", T0 + 9000), detail("c", "2", T0 + 9500))
    far = changes(order("9", FAR), detail("z", "9", FAR), *extras("z", FAR))
    feed.add(first, later, far)
    feed.run(jobs.dwd_order_detail, feed.out)
    got = read_upserts(spark, feed.out, schemas.ORDER_DETAIL).where("id <> 'z'")
    same(got, PF.dwd_order_detail(first.unionByName(later)))


def test_order_detail_stream_keeps_the_latest_of_each_side(spark, feed, changes):
    def activity(ts, name):
        return ("order_detail_activity", "c", ts, None, {"order_detail_id": "a", "activity_id": name, "activity_rule_id": "R"})
    placed, moved = order("1", T0), order("1", T0 + 1000, "u", {"province_id": "p"})
    moved[4]["province_id"] = "q"
    rows = changes(moved, placed, detail("a", "1", T0 + 500), activity(T0 + 900, "new"), activity(T0 + 100, "old"))
    feed.add(rows, changes(order("9", FAR), detail("z", "9", FAR), *extras("z", FAR)))
    feed.run(jobs.dwd_order_detail, feed.out)
    got = read_upserts(spark, feed.out, schemas.ORDER_DETAIL).where("id <> 'z'")
    assert rows_of(got, "province_id", "activity_id") == [("q", "new")]
    same(got, PF.dwd_order_detail(rows))


def test_a_day_long_past_does_not_count_again(spark, feed, pages):
    feed.add(pages(("a", "a", "0", "home", T0)), pages(("a", "b", "0", "home", T0 + 40 * DAY)),
             pages(("a", "c", "0", "home", T0 + HOUR)))

    def firsts(stream, checkpoint, once):
        return append_sink(first_events_stream(stream, [daily_row("day", {})], {}, delay="60 days"), feed.out, checkpoint, once=once)

    feed.run(firsts)
    assert rows_of(spark.read.parquet(feed.out), "ts") == [(T0,), (T0 + 40 * DAY,)]


def test_order_cancel_stream_waits_for_the_cancellation(spark, feed, changes):
    def cancel(i, ts):
        return order(i, ts, "u", {"order_status": "1001"}, "1003")
    placed = changes(detail("a", "1", T0), detail("b", "2", T0), detail("c", "3", T0), *extras("b", T0))
    cancelled = changes(cancel("1", T0 + 905_000), cancel("2", T0 + 60_000), cancel("3", T0 + 905_001))
    far = changes(cancel("9", FAR), detail("z", "9", FAR), *extras("z", FAR))
    feed.add(placed.unionByName(cancelled), far)
    feed.run(jobs.dwd_order_cancel, feed.out)
    got = read_upserts(spark, feed.out, schemas.ORDER_DETAIL).where("id <> 'z'")
    assert rows_of(got, "id", "user_id", "coupon_id") == [("a", "u1", None), ("b", "u2", "C")]


def test_pay_suc_stream(spark, feed, changes, dic, tmp_path):
    def paid(o, ts, kind="1"):
        return ("payment_info", "u", ts, {"payment_status": "1601"},
                {"order_id": o, "payment_type": kind, "payment_status": "1602"})
    facts = str(tmp_path / "facts")
    detail_rows = spark.createDataFrame([(i, o, *[None] * 14, ts) for i, o, ts in (
        ("a", "1", T0), ("b", "1", T0 + 1), ("c", "2", T0), ("d", "3", T0))], schemas.ORDER_DETAIL)
    detail_rows.coalesce(1).write.parquet(facts)
    payments = changes(paid("1", T0 + 900_000), paid("2", T0 + 900_001), paid("3", T0 - 5_000, "9"))
    feed.add(payments)
    feed.run(jobs.dwd_pay_suc, read_order_detail(spark, facts, streaming=True), lambda s: dic, feed.out)
    same(spark.read.parquet(f"{feed.out}/batches").drop("batch"), PF.dwd_pay_suc(payments, detail_rows, dic))


def test_refund_stream(spark, feed, changes, dic):
    def refund(i, o, ts):
        return ("order_refund_info", "c", ts, None, {"id": i, "order_id": o, "refund_type": "1", "refund_reason_type": "7"})
    rows = changes(order("1", T0, "u", {"order_status": "1002"}, "1005"), refund("r", "1", T0 + 5000),
                   refund("s", "2", T0), order("3", T0, "u", {}, "1005"), refund("t", "3", T0))
    feed.add(rows)
    feed.run(jobs.dwd_refund, lambda s: dic, feed.out)
    got = read_upserts(spark, feed.out, schemas.REFUND)
    same(got, PF.dwd_refund(rows, dic))


def test_comment_and_cart_streams(spark, feed, changes, dic, tmp_path):
    rows = changes(("comment_info", "c", 1, None, {"id": "a", "appraise": "1"}),
                   ("comment_info", "c", 2, None, {"id": "b", "appraise": "9"}),
                   ("cart_info", "u", 3, {"sku_num": "1"}, {"id": "c", "sku_num": "4"}))
    feed.add(rows)
    feed.run(jobs.dwd_comment, lambda s: dic, feed.out)
    same(spark.read.parquet(f"{feed.out}/batches").drop("batch"), PF.dwd_comment(rows, dic))
    query = jobs.dwd_cart_add(feed.stream(), str(tmp_path / "cart"), str(tmp_path / "cart_cp"), once=True)
    query.awaitTermination()
    same(spark.read.parquet(str(tmp_path / "cart")), PF.dwd_cart_add(rows))


def test_dim_stream_follows_config(spark, feed, changes):
    parts = [changes(("t", "c", 1, None, {"id": "1", "a": "x"}), ("t", "c", 2, None, {"id": "2", "a": "x"})),
             changes(("t", "d", 3, {"id": "1"}, None), ("t", "u", 4, {}, {"id": "2", "a": None, "b": "y"})),
             changes(("t", "c", 5, None, {"id": "1", "b": "z"})), changes(("t", "c", 6, None, {"id": "3"}))]
    feed.add(*parts)

    def config(session):
        return config_feed(spark, ("c", 0, None, CONFIG))

    feed.run(jobs.dim_sync, config, feed.out, every=2)
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    got = jobs.read_dims(spark, feed.out, config)
    assert {r.row_key: r.data for r in got.collect()} == \
        {r.row_key: r.data for r in PR.dim_sync(whole, config(spark)).collect()}
    dropped = jobs.read_dims(spark, feed.out, lambda s: config_feed(spark, ("c", 0, None, CONFIG), ("u", 4, CONFIG, CONFIG)))
    assert {r.row_key for r in dropped.collect()} == {"1", "3"}


def test_base_db_stream(spark, feed, changes):
    rows = changes(("user_info", "c", 1, None, {"id": "1", "login_name": "n", "x": "y"}), ("user_info", "d", 2, {"id": "1"}, None))
    feed.add(rows)
    feed.run(jobs.dwd_base_db, lambda s: X.dwd_config_changes(s), feed.out)
    got = spark.read.text(f"{feed.out}/batches").select("sink_table", "value")
    assert [(t, json.loads(v)) for t, v in rows_of(got)] == [("dwd_user_register", {"id": "1", "login_name": "n"})]


def test_base_log_stream_repairs_across_batches(spark, feed, tmp_path):
    def line(mid, is_new, ts):
        return json.dumps({"common": {"mid": mid, "is_new": is_new}, "page": {"page_id": "p"}, "ts": ts})
    batches = [[line("a", "1", T0), line("b", "0", T0), "{bad", json.dumps({"ts": 1})],
               [line("a", "1", T0 + DAY), line("b", "1", T0 + 1), line("c", "1", T0 + DAY)],
               [line("c", "1", T0 + DAY + 1), line("a", "0", T0)]]
    feed.add(*[spark.createDataFrame([(t,) for t in b], "value string") for b in batches])
    feed.run(jobs.dwd_base_log, feed.out, str(tmp_path / "state"))
    v = F.col("value")
    got = spark.read.text(f"{feed.out}/batches").select(
        "topic", F.get_json_object(v, "$.common.mid").alias("m"), F.get_json_object(v, "$.common.is_new").alias("n"),
        F.get_json_object(v, "$.ts").cast("long").alias("ts"))
    p = "dwd_traffic_page"
    assert rows_of(got) == sorted([(p, "a", "1", T0), (p, "a", "0", T0 + DAY), (p, "a", "0", T0), (p, "b", "0", T0),
                                   (p, "b", "0", T0 + 1), (p, "c", "1", T0 + DAY), (p, "c", "1", T0 + DAY + 1)], key=str)


def test_ods_stream_lands_by_table(spark, tmp_path):
    source = tmp_path / "lines"
    source.mkdir()
    good = {"op": "c", "after": {"id": "1"}, "source": {"db": "shop", "table": "t"}, "ts_ms": T0}
    (source / "a.txt").write_text(json.dumps(good) + "\n{bad\n")
    lines = read_json_stream(spark, str(source), fmt="text")
    jobs.ods_ingest(lines, str(tmp_path / "ods"), str(tmp_path / "cp"), once=True).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "ods"))
    assert rows_of(got, "source_table", F.col("day").cast("string")) == [("t", "2024-01-01")]
    assert json.loads(got.first().value) == good


def held_state(spark, checkpoint):
    """Keys and values of the stateful step, which is the first of its query."""
    reader = spark.read.format("statestore").option("stateVarName", "seen")
    # Operators are numbered from the sink: the windows come first where there are any.
    for operator in ("1", "0"):
        try:
            rows = reader.option("operatorId", operator).load(checkpoint)
            return {(*r["key"],): r["value"]["value"] for r in rows.collect()}
        except Exception as e:  # noqa: BLE001
            error = e
    raise error


def firsts_job(feed, kinds, delay="5 seconds"):
    def start(stream, checkpoint, once):
        rows = [daily_row("day", {})] if kinds == "day" else [session_row({})]
        return append_sink(first_events_stream(stream, rows, {}, delay=delay), feed.out, checkpoint, once=once)
    return start


def test_a_stopped_query_goes_on_with_its_sessions(spark, feed, pages):
    """The clock does not count: a pause of the query forgets nothing, one of the session does."""
    minute = 60_000
    parts = [[T0, T0 + 20 * minute], [T0 + 50 * minute, T0 + 109 * minute], [T0 + 169 * minute, T0 + 228 * minute]]
    for times in parts:
        feed.add(pages(*[("a", "s", "0", "home", t) for t in times]))
        feed.run(firsts_job(feed, "session"))
    whole = pages(*[("a", "s", "0", "home", t) for times in parts for t in times])
    assert rows_of(spark.read.parquet(feed.out), "ts") == rows_of(session_starts(whole, {}), "ts") == [(T0,), (T0 + 169 * minute,)]


def test_state_goes_behind_the_watermark(spark, feed, pages):
    feed.add(pages(*[(f"m{i}", f"s{i}", "0", "home", T0 + i) for i in range(20)]))
    feed.run(firsts_job(feed, "session"))
    assert len(held_state(spark, feed.checkpoint)) == 20
    feed.add(pages(("m1", "s1", "0", "home", T0 + HOUR // 2)), pages(("far", "far", "0", "home", T0 + HOUR + 60_000)))
    feed.run(firsts_job(feed, "session"))
    # The session that went on is still there, those an hour old are not.
    assert {k[1]: v for k, v in held_state(spark, feed.checkpoint).items()} == {"s1": T0 + HOUR // 2, "far": T0 + HOUR + 60_000}
    feed.add(pages(("farther", "farther", "0", "home", FAR)))
    feed.run(firsts_job(feed, "session"))
    assert {k[1] for k in held_state(spark, feed.checkpoint)} == {"farther"}


def test_days_of_years_are_one_number_for_each_span(spark, feed, pages):
    """Two years of one device, all days: a number for each 32 days, and one update touches one of them."""
    feed.add(pages(*[("a", "s", "0", "home", T0 + d * DAY) for d in range(730)]))
    feed.run(firsts_job(feed, "day", "1000 days"))
    before = held_state(spark, feed.checkpoint)
    first = T0 // DAY
    assert len(before) == len({(first + d) // 32 for d in range(730)}) == 24 and max(before.values()) < 1 << 32
    feed.add(pages(("a", "s", "0", "home", T0 + 5), ("a", "s", "0", "home", T0 + 730 * DAY)))
    feed.run(firsts_job(feed, "day", "1000 days"))
    after = held_state(spark, feed.checkpoint)
    assert sum(after[k] != before.get(k) for k in after) == 1
    assert spark.read.parquet(feed.out).count() == 731


def test_days_out_of_order(spark, feed, pages):
    """Across a span's end and within one batch, in any order."""
    first = T0 // DAY // 32 * 32 * DAY
    feed.add(pages(*[("a", "s", "0", "home", first + t) for t in (-1, -DAY, -33 * DAY, 0, 5, -2)]))
    feed.run(firsts_job(feed, "day", "60 days"))
    assert {r.ts - first for r in spark.read.parquet(feed.out).collect()} == {-DAY, -33 * DAY, 0}


def test_pay_suc_takes_names_the_dictionary_has_by_then(spark, feed, changes, dic, tmp_path):
    """A code that is added between two batches names the rows of the second one, without a new start."""
    def paid(o, ts):
        return ("payment_info", "u", ts, {"payment_status": "1601"}, {"order_id": o, "payment_type": "9", "payment_status": "1602"})
    facts = str(tmp_path / "facts")
    spark.createDataFrame([(i, o, *[None] * 14, T0) for i, o in (("a", "1"), ("b", "2"))], schemas.ORDER_DETAIL).coalesce(1).write.parquet(facts)
    feed.add(changes(paid("1", T0)), changes(paid("2", T0 + 1)))
    asked = []

    def now(session):
        asked.append(1)
        return dic if len(asked) == 1 else dic.unionByName(session.createDataFrame([("9", ("nine",))], schemas.BASE_DIC))

    feed.run(jobs.dwd_pay_suc, read_order_detail(spark, facts, streaming=True), now, feed.out)
    got = spark.read.parquet(f"{feed.out}/batches")
    assert rows_of(got, "order_detail_id", "payment_type_name") == [("a", None), ("b", "nine")]
    assert len(asked) >= 2


def test_refund_takes_names_the_dictionary_has_by_then(spark, feed, changes, dic):
    def refund(i, o):
        return ("order_refund_info", "c", T0, None, {"id": i, "order_id": o, "refund_type": "9", "refund_reason_type": "1"})
    for n, o in enumerate("12"):
        feed.add(changes(order(o, T0, "u", {"order_status": "1002"}, "1005"), refund(f"r{o}", o)))
    asked = []

    def now(session):
        asked.append(1)
        return dic if len(asked) == 1 else dic.unionByName(session.createDataFrame([("9", ("nine",))], schemas.BASE_DIC))

    feed.run(jobs.dwd_refund, now, feed.out)
    got = read_upserts(spark, feed.out, schemas.REFUND)
    assert rows_of(got, "id", "refund_type_name", "refund_reason_type_name") == [("r1", None, "one"), ("r2", "nine", "one")]


@pytest.mark.parametrize("band_ms", [0, 1_000, 5_000, 60_000])
def test_band_of_static_plan_and_stream(spark, feed, changes, band_ms):
    """Both keep the same rows, and both the same unmatched ones, at any band."""
    rows = changes(order("1", T0), order("1", T0 + 2000, "u", {}), order("2", T0 + 50_000), detail("a", "1", T0 + 1000), detail("a", "1", T0 + 4000, sku_num="7"),
                   detail("b", "1", T0 + 5000), detail("b", "1", T0 + 5001, sku_num="8"), detail("c", "2", T0), detail("x", "none", T0),
                   detail("n", None, T0), *extras("a", T0 + 2000), *extras("b", T0 + 5000), *extras("c", T0 + 50_000))
    feed.add(rows, changes(order("9", FAR), detail("z", "9", FAR), *extras("z", FAR)))
    feed.run(jobs.dwd_order_detail, feed.out, band_ms=band_ms, unmatched=f"{feed.out}-unmatched")
    got = read_upserts(spark, feed.out, schemas.ORDER_DETAIL).where("id <> 'z'")
    assert rows_of(got) == rows_of(PF.dwd_order_detail(rows, band_ms=band_ms).select(*got.columns))
    left = spark.read.parquet(f"{feed.out}-unmatched/batches").where("id <> 'z'").drop("batch")
    want = bands.unmatched(bands.order_details(rows, band_ms=band_ms))
    assert rows_of(left, *sorted(want.columns)) == rows_of(want, *sorted(want.columns)) != []
    ids = {r.id for r in got.collect()}
    assert ids == {0: set(), 1_000: {"a"}, 5_000: {"a", "b"}, 60_000: {"a", "b", "c"}}[band_ms]


def test_cancel_and_refund_bands_of_static_plans(changes, dic):
    def cancel(i, ts):
        return order(i, ts, "u", {"order_status": "1001"}, "1003")
    rows = changes(detail("a", "1", T0), detail("b", "2", T0), cancel("1", T0 + 905_000), cancel("2", T0 + 905_001),
                   order("3", T0, "u", {"order_status": "1002"}, "1005"),
                   *[("order_refund_info", "c", T0 + d, None, {"id": str(d), "order_id": "3", "refund_type": "1", "refund_reason_type": "2"})
                     for d in (5_000, 5_001)])
    assert rows_of(PF.dwd_order_cancel(rows, wait_ms=905_000), "id") == [("a",)]
    assert rows_of(PF.dwd_order_cancel(rows), "id") == [("a",), ("b",)]
    assert rows_of(PF.dwd_refund(rows, dic, band_ms=5_000), "id") == [("5000",)]
    assert PF.dwd_refund(rows, dic).count() == 2


def test_numbers_stay_numbers_through_the_split(spark, tmp_path):
    """Raw lines cleaned, split and read back: what was a number is one, what was a text stays one."""
    raw = {"common": {"mid": "m", "is_new": "0"}, "page": {"page_id": "home", "item": "12", "during_time": 77, "last_page_id": ',"during_time":"5"'},
           "displays": [{"item": "3", "pos_id": 4}], "err": {"error_code": 1001, "msg": "007"}, "ts": T0}
    odd = {"common": {"mid": "m"}, "page": {"page_id": "home", "during_time": "007"}, "ts": T0}
    lines = spark.createDataFrame([(json.dumps(r),) for r in (raw, odd)], "value string")
    out = {}
    for t, v in rows_of(PT.dwd_base_log(clean_json(lines, schemas.APP_LOG))):
        out.setdefault(t, []).append(json.loads(v))
    pages = sorted((p["page"] for p in out["dwd_traffic_page"]), key=len)
    assert pages == [{"page_id": "home", "during_time": "007"}, raw["page"]]
    assert out["dwd_traffic_display"] == [{"item": "3", "pos_id": 4, "mid": "m", "is_new": "0", "ts": T0}]
    assert out["dwd_traffic_err"][0]["err"] == {"error_code": 1001, "msg": "007"}
