import json

from conftest import rows_of
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.functions import times
from rillhouse.functions.names import to_camel, to_snake
from rillhouse.operators import logs, windows
from rillhouse.plans import traffic
from rillhouse.sinks import route_sink, to_json_rows, to_snake_json
from rillhouse.streaming.sinks import topic_rows

LOG = {"common": {"mid": "m", "is_new": "1", "extra": "kept"}, "ts": 5,
       "displays": [{"item": "1", "mid": "clash", "n": None}, {"item": "2"}], "actions": [{"action_id": "a"}],
       "start": {"entry": "icon"}, "err": {"code": "1"}, "page": {"page_id": "home"}}


def frame(spark, *records):
    text = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    return text.select(F.from_json("value", schemas.APP_LOG).alias("r")).select("r.*")


def test_split_into_five_topics(spark):
    out = [(t, json.loads(v)) for t, v in rows_of(logs.split_log(frame(spark, LOG)))]
    common = LOG["common"]
    by = {t: [v for x, v in out if x == t] for t, _ in out}
    assert by["dwd_traffic_display"] == [{"item": "1", **common, "ts": 5}, {"item": "2", **common, "ts": 5}]
    assert by["dwd_traffic_action"] == [{"action_id": "a", **common}]
    assert set(by["dwd_traffic_err"][0]) == {"common", "page", "start", "err", "ts"}
    assert set(by["dwd_traffic_page"][0]) == {"common", "page", "start", "ts"}
    assert set(by["dwd_traffic_start"][0]) == set(LOG)


def test_split_equals_the_single_outputs(spark):
    df = frame(spark, LOG, {"common": {"mid": "n"}, "ts": 6, "displays": [], "page": {"page_id": "x"}},
               {"common": {"mid": "o"}, "ts": 7})
    counts = dict(logs.split_log(df).groupBy("topic").count().collect())
    singles = {"start": logs.log_start, "display": logs.log_display, "action": logs.log_action,
               "err": logs.log_err, "page": logs.log_page}
    assert counts == {f"dwd_traffic_{n}": f(df).count() for n, f in singles.items()}
    assert logs.log_page(df).columns == ["common", "page", "start", "ts"]


def test_rows_without_device_are_dropped(spark):
    df = frame(spark, {"ts": 1, "page": {"page_id": "x"}}, {"common": {"vc": "1"}, "ts": 1}, LOG)
    assert logs.with_device(df).count() == 1


def test_keywords(spark):
    rows = [("Red red RING", "home", "keyword"), ("-- !", "home", "keyword"), (None, "home", "keyword"),
            ("blue", None, "keyword"), ("blue", "home", "sku_id"), ("été 2024", "home", "keyword")]
    df = spark.createDataFrame([((None, "x", None, None, None, None), (None, last, item, kind, None), 1000)
                                for item, last, kind in rows], schemas.PAGE_LOG_TYPED)
    got = rows_of(traffic.dws_keyword(df), "stt", "cur_date", "keyword", "keyword_count")
    at = ("1970-01-01 00:00:00", "19700101")
    assert got == sorted([(*at, w, 1) for w in ("red", "ring", None, "été", "2024")], key=str)


def test_keyword_of_null_text(spark):
    df = spark.createDataFrame([(None,), ("",)], "keywords string")
    assert rows_of(windows.split_keywords(df)) == [(None,), (None,)]


def test_time_texts(spark):
    df = spark.sql("SELECT 1688518861000L AS ms")
    got = df.select(
        times.ms_to_date(F.col("ms")), times.ms_to_datetime(F.col("ms")), times.ms_to_partition_date(F.col("ms")),
        times.datetime_to_ms(F.lit("2023-07-05 01:01:01")), times.date_to_ms(F.lit("2023-07-05")),
        times.datetime_to_ms(F.lit("soon")), times.datetime_to_ms(F.lit(None).cast("string")),
        times.epoch_day_text(F.lit(19543)), times.time_text(F.lit(3_661_000_000)), times.time_text(F.lit(1_500_000)),
        times.time_text(F.lit(86_400_000_000)), times.time_text(F.lit(-1)),
        times.datetime_text(F.lit("2023-07-05 01:01:01.500").cast("timestamp_ntz")),
        times.timestamp_text(F.lit("2023-07-05 20:00:00").cast("timestamp_ntz"), "Asia/Shanghai")).first()
    assert tuple(got) == (
        "2023-07-05", "2023-07-05 01:01:01", "20230705", 1688490061000, 1688486400000, None, None,
        "2023-07-05", "01:01:01", "00:00:01.5", None, None, "2023-07-05 01:01:01.5", "2023-07-06 04:00:00")


def test_text_to_ms_does_not_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.range(1).select(times.datetime_to_ms(F.lit("2023-07-05 01:01:01")),
                                    times.time_text(F.lit(1_000_000)), times.ms_to_date(F.lit(0))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == (1688490061000, "00:00:01", "1969-12-31")


def test_names_and_json(spark):
    assert to_camel("source_table") == "sourceTable" and to_snake("goodDetailUvCt") == "good_detail_uv_ct"
    df = spark.createDataFrame([("a", 1, 9)], "curDate string, homeUvCt long, ts long")
    assert rows_of(to_snake_json(df, ("ts",))) == [('{"cur_date":"a","home_uv_ct":1}',)]
    assert rows_of(to_json_rows(df.withColumn("n", F.lit(None).cast("string")))) == \
        [('{"curDate":"a","homeUvCt":1,"ts":9}',)]


def test_topics(spark):
    import pytest
    df = spark.createDataFrame([("t", "v")], "topic string, value string")
    assert rows_of(topic_rows(df)) == [("t", "v")]
    assert rows_of(topic_rows(df.drop("topic"), "u")) == [("u", "v")]
    with pytest.raises(ValueError):
        topic_rows(df.drop("topic"))


def test_route_sink_writes_one_folder_per_route(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "sink_table string, value string")
    route_sink(df, str(tmp_path / "out"), fmt="text")
    assert sorted(p.name for p in (tmp_path / "out").glob("sink_table=*")) == ["sink_table=a", "sink_table=b"]
    assert rows_of(spark.read.text(str(tmp_path / "out")), "sink_table", "value") == rows_of(df)
