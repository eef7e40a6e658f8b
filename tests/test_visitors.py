import random
from collections import defaultdict

from conftest import rows_of
from pyspark.sql import functions as F

from rillhouse.operators import visitors as V
from rillhouse.operators import windows as W
from rillhouse.plans import traffic

DAY, HOUR = 86_400_000, 3_600_000
T0 = 1_704_067_200_000
ORDER = ("ts", "id")


def flags(df):
    return [r[1] for r in sorted(df.select("id", F.col("common")["is_new"]).collect())]


def test_flag_is_cleared_on_a_later_day(pages):
    df = pages(("m", "s", "1", "home", T0), ("m", "s", "1", "home", T0 + HOUR), ("m", "s", "1", "home", T0 + DAY),
               ("n", "s", "0", "home", T0), ("n", "s", "1", "home", T0 + 1), ("n", "s", None, "home", T0 + 2))
    assert flags(V.new_visitor_repair(df, ORDER)) == ["1", "1", "0", "0", "0", None]


def test_old_flag_first_counts_as_yesterday(pages):
    df = pages(("m", "s", "0", "home", T0 + DAY), ("m", "s", "1", "home", T0))
    assert flags(V.new_visitor_repair(df, ORDER)) == ["0", "1"]
    assert [str(r[1]) for r in V.first_visits(df, ORDER).collect()] == ["2024-01-01"]


def test_repair_works_on_maps(spark):
    df = spark.createDataFrame([({"mid": "m", "is_new": "1", "x": "y"}, T0), ({"mid": "m", "is_new": "1"}, T0 + DAY)],
                               "common map<string,string>, ts long")
    got = {r.ts: r.common for r in V.new_visitor_repair(df).collect()}
    assert got[T0] == {"mid": "m", "is_new": "1", "x": "y"} and got[T0 + DAY]["is_new"] == "0"


def random_pages(pages, n=600, seed=3):
    """A third of all rows belongs to one device and one session id."""
    rng, ts, rows = random.Random(seed), T0, []
    for _ in range(n):
        ts += rng.choice([0, 1, 60_000, 20 * 60_000, HOUR - 1, HOUR])
        mid = "hot" if rng.random() < 0.34 else f"m{rng.randrange(20)}"
        rows.append((mid, f"s-{mid}", rng.choice("01"), rng.choice(["home", "good_detail", "x"]), ts))
    return rows, pages(*rows)


def test_rules_equal_row_by_row_state(pages):
    rows, df = random_pages(pages)
    first, last_day, last_ts, page_day = {}, {}, {}, {}
    want = defaultdict(list)
    for i, (mid, sid, is_new, page, ts) in enumerate(rows):
        day = ts // DAY
        if mid not in first:
            first[mid] = day if is_new == "1" else day - 1
        want["flag"].append("0" if is_new == "1" and day != first[mid] else is_new)
        if last_day.get(mid) != day:
            want["uv"].append(i)
        last_day[mid] = day
        if sid not in last_ts or ts - last_ts[sid] >= HOUR:
            want["sv"].append(i)
        last_ts[sid] = ts
        if page != "x" and page_day.get((mid, page)) != day:
            page_day[mid, page] = day
            want["hd"].append((mid, page, ts))
    dims = W.traffic_dims()
    assert flags(V.new_visitor_repair(df, ORDER)) == want["flag"]
    assert [r[0] for r in rows_of(V.daily_visitors(df, dims, ORDER).select(F.col("id").cast("int")))] == \
        sorted(want["uv"], key=lambda i: str((i,)))
    assert [r[0] for r in rows_of(V.session_starts(df, dims, ORDER).select(F.col("id").cast("int")))] == \
        sorted(want["sv"], key=lambda i: str((i,)))
    got = rows_of(V.home_detail_visitors(W.home_detail_pages(df)), "mid", "page_id", "ts")
    assert got == sorted(want["hd"], key=str)


def test_session_gap_of_exactly_an_hour_opens_a_session(pages):
    df = pages(("m", "s", "0", "home", T0), ("m", "s", "0", "home", T0 + HOUR - 1),
               ("m", "s", "0", "home", T0 + 2 * HOUR - 1), ("m", None, "0", "home", T0))
    assert rows_of(V.session_starts(df, {}, ORDER), "ts") == [(T0,), (T0 + 2 * HOUR - 1,)]


def test_visitor_counts_once_a_day_even_out_of_order(pages):
    df = pages(("m", "s", "0", "home", T0), ("m", "s", "0", "home", T0 + DAY), ("m", "s", "0", "home", T0 + 5))
    assert V.daily_visitors(df, {}, ORDER).count() == 2


def test_traffic_sums(pages):
    df = pages(("m", "s", "0", "home", T0), ("m", "s", "0", "home", T0 + 4_999), ("m", "s", "0", "home", T0 + 5_000),
               ("n", "t", "1", "home", T0 + 1))
    got = rows_of(traffic.dws_traffic(df, order=ORDER), "stt", "edt", "cur_date", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum")
    assert got == [("2024-01-01 00:00:00", "2024-01-01 00:00:05", "20240101", "0", 1, 1, 2, 20),
                   ("2024-01-01 00:00:00", "2024-01-01 00:00:05", "20240101", "1", 1, 1, 1, 10),
                   ("2024-01-01 00:00:05", "2024-01-01 00:00:10", "20240101", "0", 0, 0, 1, 10)]


def test_home_detail_needs_a_device(pages):
    df = pages(("m", "s", "0", "home", T0), ("m", "s", "0", "good_detail", T0), (None, "s", "0", "home", T0),
               ("m", "s", "0", "home", T0 + 10_000), ("n", "s", "0", "x", T0))
    assert rows_of(traffic.dws_home_detail(df), "stt", "home_uv_ct", "good_detail_uv_ct") == \
        [("2024-01-01 00:00:00", 1, 1)]
