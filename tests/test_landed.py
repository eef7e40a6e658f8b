"""The landed feed: what is read of it, and what is read back."""

import json
import re

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_facts import order_feed

from rillhouse.operators import facts as P
from rillhouse.plans import facts as PF
from rillhouse.plans import routing as PR
from rillhouse.sources import feeds
from rillhouse.sources.testfeeds import json_lines
from rillhouse.streaming import jobs

DAY = 86_400_000
T0 = 1_704_067_200_000


@pytest.fixture
def ods(spark, changes, tmp_path):
    """Landed changes of three days and five tables, with lines that are no changes."""
    later = changes(*[("order_detail", "c", T0 + n * DAY, None, {"id": f"x{n}", "order_id": "o1"}) for n in range(3)],
                    ("comment_info", "c", T0, None, {"id": "c"}), (None, "c", T0, None, {"id": "nowhere"}))
    feed = order_feed(changes).unionByName(later)
    lines = json_lines(feed).unionAll(spark.createDataFrame([("{bad",), (None,), ("7",)], "value string"))
    lines.write.parquet(str(tmp_path / "lines"))
    stream = spark.readStream.schema("value string").parquet(str(tmp_path / "lines"))
    jobs.ods_ingest(stream, str(tmp_path / "ods"), str(tmp_path / "cp"), once=True).awaitTermination()
    return str(tmp_path / "ods"), feed


def scans(df):
    """What each scan of the plan as run filters partitions by."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.findall(r"FileScan parquet.*?PartitionFilters: \[(.*?)\], PushedFilters", plan)


def test_facts_from_the_landed_feed(spark, ods):
    path, feed = ods
    got = PF.dwd_order_detail(feeds.ods_tables(spark, path))
    assert rows_of(got) == rows_of(PF.dwd_order_detail(feed)) != []
    cancelled = PF.dwd_order_cancel(feeds.ods_tables(spark, path))
    assert rows_of(cancelled) == rows_of(PF.dwd_order_cancel(feed)) != []


def test_each_needed_table_is_scanned_once(spark, ods):
    found = scans(PF.dwd_order_detail(feeds.ods_tables(spark, ods[0])))
    tables = sorted(re.search(r"source_table#\d+ = (\w+)\)", f)[1] for f in found)
    assert tables == ["order_detail", "order_detail_activity", "order_detail_coupon", "order_info"]


def test_tables_and_days_prune_partitions(spark, ods):
    path, feed = ods
    one = feeds.read_ods(spark, path, ("order_detail",), ("2024-01-02", "2024-01-03"))
    assert rows_of(one, F.col("after")["id"]) == [("x1",), ("x2",)]
    (found,) = scans(one)
    assert "source_table" in found and "day" in found
    every = feeds.read_ods(spark, path)
    assert every.count() == feed.count()
    assert feeds.read_ods(spark, path, ("none",)).count() == 0
    two = feeds.read_ods(spark, path, ("order_info", "comment_info"))
    assert {r[0] for r in rows_of(two, F.col("source")["table"])} == {"order_info", "comment_info"}


def test_a_folder_that_a_static_job_wrote(spark, ods, tmp_path):
    """Without the streaming query's own list of files only the named tables' folders are listed."""
    path, feed = str(tmp_path / "static"), ods[1]
    PR.ods_ingest(json_lines(feed)).write.partitionBy("source_table", "day").parquet(path)
    got = feeds.read_ods(spark, path, ("order_info", "none"))
    assert all("source_table=order_info" in f for f in got.inputFiles()) and got.count() == 2
    assert feeds.read_ods(spark, path, ("none",)).count() == 0
    assert feeds.read_ods(spark, path).count() == feed.count()
    assert rows_of(PF.dwd_order_detail(feeds.ods_tables(spark, path))) == rows_of(PF.dwd_order_detail(feed))


def test_landed_feed_as_a_stream(spark, ods, tmp_path):
    path, feed = ods
    stream = feeds.stream_ods(spark, path, "comment_info")
    query = jobs.append_sink(P.comment_src(stream, "shop"), str(tmp_path / "out"), str(tmp_path / "cp2"), once=True)
    query.awaitTermination()
    assert rows_of(spark.read.parquet(str(tmp_path / "out")), "id") == [("c",)]


def test_a_hot_table_lands_in_few_files(spark, tmp_path):
    """One table of one day: rows of many tasks end in at most four files, not in one for each task."""
    line = F.concat(F.lit('{"op":"c","ts_ms":1704067200000,"source":{"db":"shop","table":"t"},"after":{"id":"'), F.col("id"), F.lit('"}}'))
    spark.range(4000).repartition(40).select(line.alias("value")).write.parquet(str(tmp_path / "lines"))
    stream = spark.readStream.schema("value string").parquet(str(tmp_path / "lines"))
    jobs.ods_ingest(stream, str(tmp_path / "ods"), str(tmp_path / "cp"), once=True).awaitTermination()
    files = list((tmp_path / "ods").rglob("*.parquet"))
    assert 1 <= len(files) <= 4
    assert feeds.read_ods(spark, str(tmp_path / "ods"), ("t",)).count() == 4000


def test_records_keep_their_line(spark, changes):
    feed = changes(("t", "c", T0, None, {"id": "1"}))
    row = PR.ods_ingest(json_lines(feed)).first()
    assert (row["source_table"], str(row["day"]), json.loads(row["value"])["op"]) == ("t", "2024-01-01", "c")
