import json

from conftest import rows_of
from pyspark.sql import functions as F

from rillhouse import schemas, settings as S
from rillhouse.operators import clean
from rillhouse.operators.logs import split_log, with_device
from rillhouse.plans.traffic import dws_traffic
from rillhouse.sources import feeds


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


GOOD = json.dumps({"op": "u", "before": {"id": "5"}, "after": {"id": "5", "n": 7},
                   "source": {"db": "shop", "table": "t"}, "ts_ms": 1718430000000})


def test_malformed_and_null_lines_are_dropped(spark):
    df = clean.clean_json(lines(spark, GOOD, "{broken", "plain text", None, ""), schemas.CHANGE)
    assert rows_of(df, F.col("after")["id"], "op", "ts_ms") == [("5", "u", 1718430000000)]
    assert df.select(F.col("after")["n"]).first()[0] == "7"
    assert df.select(F.col("after")["missing"]).first()[0] is None


def test_other_columns_are_kept(spark):
    df = lines(spark, GOOD).withColumn("offset", F.lit(3))
    assert clean.clean_json(df, schemas.CHANGE).columns[0] == "offset"


def test_deletes_are_dropped_but_missing_op_stays(spark):
    deleted = json.dumps({"op": "d", "before": {"id": "1"}})
    no_op = json.dumps({"after": {"id": "2"}})
    df = clean.clean_cdc(lines(spark, GOOD, deleted, no_op, "{"))
    assert rows_of(df, F.col("after")["id"]) == [("2",), ("5",)]


def test_read_cdc_ignores_bad_lines(spark):
    df = feeds.read_cdc(lines(spark, GOOD, "{broken", "12"))
    assert rows_of(df, "op", F.date_format("et", "yyyy-MM-dd HH:mm:ss")) == [("u", "2024-06-15 05:40:00")]


def test_page_log_schemas_agree(spark):
    text = json.dumps({"common": {"mid": "m"}, "page": {"page_id": "home", "during_time": 5}, "ts": 1000})
    for typed in (True, False):
        df = feeds.read_page_log(lines(spark, text, "x"), typed)
        assert rows_of(df, F.col("common")["mid"], F.col("page")["during_time"].cast("bigint")) == [("m", 5)]


def test_whole_numbers_may_be_quoted(spark):
    texts = [json.dumps({"common": {"mid": m}, "page": {"page_id": "home", "during_time": d}, "ts": ts})
             for m, d, ts in (("a", "1234", "1000"), ("b", 5, 2000), ("c", "x", None), ("d", 1.5, "y"))]
    kept = clean.clean_json(lines(spark, *texts), schemas.APP_LOG)
    assert sorted(tuple(r) for r in kept.select(F.col("common")["mid"], "ts").collect()) == \
        [("a", 1000), ("b", 2000), ("c", None), ("d", None)]
    typed = feeds.read_page_log(lines(spark, *texts), typed=True)
    assert sorted(tuple(r) for r in typed.select("common.mid", "page.during_time", "ts").collect()) == \
        [("a", 1234, 1000), ("b", 5, 2000), ("c", None, None), ("d", None, None)]


def test_durations_survive_the_log_split(spark):
    text = json.dumps({"common": {"mid": "m", "is_new": "0", "sid": "s"}, "page": {"page_id": "home", "during_time": 1234}, "ts": 1000})
    split = split_log(with_device(clean.clean_json(lines(spark, text), schemas.APP_LOG)))
    pages = feeds.read_page_log(split.where(F.col("topic") == S.TOPIC_PAGE).select("value"), typed=True)
    assert rows_of(dws_traffic(pages), "pv_ct", "dur_sum") == [(1, 1234)]


def test_cdc_table_takes_one_table_of_one_database(changes):
    df = changes(("a", "c", 1, None, {"id": "1"}), ("b", "c", 1, None, {"id": "2"}), ("a", "d", 2, {"id": "1"}, None))
    assert rows_of(clean.cdc_table(df, "a"), "op") == [("c",)]
    assert clean.cdc_table(df, "a", db="other").count() == 0


def test_status_transition(changes):
    def upd(before, after):
        return ("o", "u", 1, before, {"s": after})
    df = changes(upd({"s": "1001"}, "1003"), upd({"s": "1003"}, "1003"), upd({}, "1003"), upd(None, "1003"),
                 upd({"s": "1001"}, "1002"), ("o", "c", 1, None, {"s": "1003"}))
    assert clean.status_transition(df, "s", "1003", must_differ=True).count() == 1
    assert clean.status_transition(df, "s", "1003").count() == 2


def test_effective_row_and_pruning(changes):
    df = changes(("t", "d", 1, {"id": "1", "x": "a"}, None), ("t", "u", 1, {"id": "0"}, {"id": "2", "x": None}))
    df = clean.effective_row(df).withColumn("sink_columns", F.lit("id,y"))
    assert rows_of(clean.prune_columns(df), "data") == [({"id": "1"},), ({"id": "2"},)]
    assert rows_of(clean.prune_columns(df, keep=("x",)), "data") == [({"id": "1", "x": "a"},), ({"id": "2", "x": None},)]


def test_start_modes(spark, changes):
    feed = changes(("t", "c", 10, None, {"id": "1"}), ("t", "c", 20, None, {"id": "2"}))
    snapshot = feeds.snapshot_changes(spark.createDataFrame([("9", None)], "id string, x string"), "t")
    assert rows_of(feeds.changes_from(feed, from_ms=20), F.col("after")["id"]) == [("2",)]
    both = feeds.changes_from(feed, "initial", snapshot)
    assert rows_of(both, "op", F.col("after")["id"]) == [("c", "1"), ("c", "2"), ("r", "9")]


def test_config_columns_can_be_renamed(spark, tmp_path):
    from rillhouse.functions.names import camel_columns, snake_columns
    from rillhouse.sources.tables import read_config
    path = str(tmp_path / "config")
    spark.createDataFrame([("a", "b")], "source_table string, sink_row_key string").write.parquet(path)
    assert read_config(spark, path, camel=True).columns == ["sourceTable", "sinkRowKey"]
    assert snake_columns(camel_columns(read_config(spark, path))).columns == ["source_table", "sink_row_key"]


def test_change_order_goes_by_time_file_position_and_row(spark):
    places = [(2, "a.000001", "1", "0"), (1, "a.000010", "4", "1"), (1, "a.000010", "4", "0"), (1, "a.000010", "3", "9"),
              (1, "a.000009", "900", "9"), (1, "a.000009", "x", None), (1, None, "5", "1"), (1, None, None, None)]
    rows = [({"file": f, "pos": p, "row": r}, ts, n) for n, (ts, f, p, r) in enumerate(places)]
    df = spark.createDataFrame(rows[::-1], "source map<string,string>, ts_ms long, n int")
    assert [r.n for r in df.select("n", clean.change_order().alias("seq")).orderBy(F.desc("seq")).collect()] == list(range(8))
