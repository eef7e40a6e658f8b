"""Band joins over micro-batches: what is held back, when it comes out, and what lies on disk."""

import os

from conftest import SMALL, rows_of
from pyspark.sql import functions as F
from test_streaming import FAR, T0, detail, extras, feed, order  # noqa: F401

from rillhouse import catalog, schemas
from rillhouse.plans import bands
from rillhouse.plans import facts as PF
from rillhouse.sources import testfeeds as X
from rillhouse.sources.feeds import read_order_detail
from rillhouse.streaming import jobs
from rillhouse.streaming.sinks import read_upserts


def closing(ts, n="9"):
    return [order(n, ts), detail(f"z{n}", n, ts), *extras(f"z{n}", ts)]


def test_sides_that_come_apart(spark, feed, changes):  # noqa: F811
    """Details wait for their sides in later batches; what lacks one comes out once, when the watermark has passed its band."""
    parts = [[detail("a", "1", T0 + 1000), detail("b", "2", T0), detail("x", "none", T0), *extras("b", T0 + 10)],
             [order("1", T0 + 3000), order("2", T0)], [order("2", T0 + 4000, "u", {})], closing(FAR)]
    rows = [changes(*p) for p in parts]
    feed.add(*rows)
    unmatched = f"{feed.out}-unmatched"
    feed.run(jobs.dwd_order_detail, feed.out, unmatched=unmatched)
    whole = rows[0].unionByName(rows[1]).unionByName(rows[2])
    got = read_upserts(spark, feed.out, schemas.ORDER_DETAIL).where("NOT id LIKE 'z%'")
    assert rows_of(got) == rows_of(PF.dwd_order_detail(whole, band_ms=5_000).select(*got.columns)) != []
    left = spark.read.parquet(f"{unmatched}/batches").where("NOT id LIKE 'z%'").drop("batch")
    want = bands.unmatched(bands.order_details(whole))
    assert rows_of(left, *sorted(want.columns)) == rows_of(want, *sorted(want.columns)) != []
    assert not os.path.exists(f"{feed.checkpoint}/state")


def test_a_match_is_written_once_and_held_rows_go(spark, feed, changes, dic, tmp_path):  # noqa: F811
    def paid(o, ts):
        return ("payment_info", "u", ts, {"payment_status": "1601"}, {"order_id": o, "payment_type": "1", "payment_status": "1602"})
    facts, parts = str(tmp_path / "facts"), [[("a", "1", T0), ("b", "2", T0)], [("c", "1", T0 + 5)], [("z", "9", FAR)], [("y", "8", FAR + 10**7)]]
    for p in parts:
        spark.createDataFrame([(i, o, *[None] * 14, ts) for i, o, ts in p], schemas.ORDER_DETAIL).coalesce(1).write.mode("append").parquet(facts)
        feed.add(changes(paid("1", T0 + 7) if p[0][0] == "a" else paid("2", T0 + 8) if p[0][0] == "c" else paid(p[0][1], p[0][2])))
        feed.run(jobs.dwd_pay_suc, read_order_detail(spark, facts, streaming=True), lambda s: dic, feed.out)
    got = spark.read.parquet(f"{feed.out}/batches")
    assert rows_of(got, "order_detail_id", "ts") == sorted([("a", T0 + 7), ("c", T0 + 7), ("b", T0 + 8), ("z", FAR), ("y", FAR + 10**7)])
    assert not os.path.exists(f"{feed.checkpoint}/state")
    held = sorted(n for n in os.listdir(f"{feed.checkpoint}/held/rows") if n.startswith("batch="))
    assert held == ["batch=2", "batch=3"]


def test_rows_before_the_watermark_are_late(spark, feed, changes):  # noqa: F811
    feed.add(changes(*closing(T0)), changes(*closing(T0 + 10**6, "8")), changes(detail("late", "9", T0 + 1)), changes(*closing(FAR, "7")))
    feed.run(jobs.dwd_order_detail, feed.out)
    assert "late" not in {r.id for r in read_upserts(spark, feed.out, schemas.ORDER_DETAIL).collect()}


def test_a_feed_lands_without_a_copy(spark):
    tables = X.Streams(SMALL)
    lines = X.json_lines(X.change_feed(spark, tables, "order_info", "order_detail"))
    assert lines.isStreaming
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    ods = catalog._ods(spark, lines)
    files = spark.read.parquet(ods).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert sorted(n for n in os.listdir(ods.rsplit("/", 1)[0])) == ["ods", "ods-checkpoint"]
    want = X.json_lines(X.change_feed(spark, SMALL, "order_info", "order_detail"))
    assert rows_of(spark.read.parquet(ods).agg(F.count("*"), F.bit_xor(F.xxhash64("value")))) == rows_of(want.agg(F.count("*"), F.bit_xor(F.xxhash64("value"))))
