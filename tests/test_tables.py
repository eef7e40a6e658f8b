"""Tables that batches add to: what is kept, what is read, and what a failure leaves."""

import re
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_visitors import DAY, T0

from rillhouse import schemas
from rillhouse.operators.upsert import upsert_latest
from rillhouse.streaming.sinks import read_upserts, upsert_table
from rillhouse.streaming.tables import BatchTable
from rillhouse.streaming.visitors import repair_batch, visits_table

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])


def latest(rows):
    return upsert_latest(rows, ["k"], F.col("n"))


@pytest.fixture
def table(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    return BatchTable(str(tmp_path / "t"), SCHEMA, ("k",), latest, buckets=4, every=5)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def folders(table, kind=""):
    return sorted(p.name for p in Path(table.path, "rows").iterdir() if p.name.startswith(f"piece={kind}"))


def test_two_hundred_batches_leave_few_folders_and_one_scan(spark, table):
    want = {}
    for n in range(200):
        rows = [(f"k{n % 7}", n), (f"once{n}", n)]
        want.update(rows)
        table.add(frame(spark, *rows), n)
        assert len(folders(table)) <= 2 * table.every + 2 * table.buckets + 1
    assert dict(rows_of(table.merged(spark))) == want
    assert len(folders(table, "batch")) <= 2 * table.every and len(list(Path(table.path, "bases").glob("*.json"))) <= 2
    df = table.read(spark)
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_a_repeated_batch_replaces_its_rows(spark, table):
    table.add(frame(spark, ("a", 1), ("b", 1)), 0)
    table.add(frame(spark, ("a", 2), ("gone", 2)), 1)
    table.add(frame(spark, ("a", 3)), 1)
    assert rows_of(table.merged(spark)) == [("a", 3), ("b", 1)]
    assert rows_of(table.merged(spark, upto=0)) == [("a", 1), ("b", 1)]


def test_a_base_holds_all_batches_before_it(spark, table):
    for n in range(4):
        table.add(frame(spark, (f"k{n}", n)), n)
    want = rows_of(table.merged(spark))
    table.compact(spark, 3)
    table.compact(spark, 3)
    assert rows_of(table.read(spark)) == want
    # The batch after the base may fail and run again, with what was there before it.
    table.add(frame(spark, ("k0", 9)), 4)
    assert rows_of(table.merged(spark, upto=3)) == want
    assert ("k0", 9) in rows_of(table.merged(spark))


def test_only_buckets_that_changed_are_written_again(spark, table):
    keys = [f"k{i}" for i in range(40)]
    table.add(frame(spark, *[(k, 1) for k in keys]), 0)
    table.compact(spark, 0)
    table.add(frame(spark, ("k0", 2)), 1)
    table.compact(spark, 1)
    rewritten = [p.name for p in Path(table.path, "rows", "piece=base-1").iterdir() if p.name.startswith("bucket=")]
    own = frame(spark, ("k0", 2)).select(table.bucket()).first()[0]
    assert rewritten == [f"bucket={own}"]
    table.add(frame(spark, ("k0", 3)), 2)
    table.compact(spark, 2)
    assert dict(rows_of(table.merged(spark))) == {**dict.fromkeys(keys, 1), "k0": 3}
    # Of the first base the changed bucket is gone, and of the second all that it held is kept for readers.
    assert f"bucket={own}" not in [p.name for p in Path(table.path, "rows", "piece=base-0").iterdir()]
    assert "piece=base-1" in folders(table)


def test_a_reader_of_the_base_before_goes_on(spark, table):
    for n in range(3):
        table.add(frame(spark, ("a", n), (f"b{n}", n)), n)
    table.compact(spark, 1)
    reader = table.merged(spark)
    table.compact(spark, 2)
    assert dict(rows_of(reader)) == {"a": 2, "b0": 0, "b1": 1, "b2": 2}


def test_a_base_that_was_not_finished_does_not_count(spark, table):
    for n in range(2):
        table.add(frame(spark, ("a", n)), n)
    table._write(frame(spark, ("wrong", 0)), "base-1")
    assert rows_of(table.merged(spark)) == [("a", 1)]
    table.compact(spark, 1)
    assert rows_of(table.read(spark)) == [("a", 1)]
    # Nor does a batch without its mark.
    table.add(frame(spark, ("b", 1)), 2)
    Path(table.path, "rows", "piece=batch-2", "_SUCCESS").unlink()
    assert rows_of(table.read(spark)) == [("a", 1)]


def test_empty_batches_and_no_table(spark, table):
    assert table.merged(spark).collect() == []
    table.compact(spark, 0)
    for n in range(12):
        table.add(frame(spark).limit(0), n)
    assert table.merged(spark).collect() == [] and len(folders(table)) <= 2 * table.every + 2


def test_buckets_are_pruned(spark, table):
    table.add(frame(spark, *[(f"k{i}", 1) for i in range(40)]), 0)
    table.compact(spark, 0)
    table.add(frame(spark, *[(f"k{i}", 2) for i in range(40)]), 1)
    found = table.read(spark, buckets=[2])
    assert {r[0] for r in found.select(table.bucket()).distinct().collect()} == {2}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert all("bucket=2" in f for f in found.inputFiles() if "piece=base" in f)


def test_upserts_over_many_batches(spark, tmp_path):
    """Merged bases give what all rows together do: latest time, then latest versions, then latest batch."""
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType()), T.StructField("ts", T.LongType())])
    path = str(tmp_path / "u")
    place = lambda *p: [(x, None, 0, 0) for x in p]
    batches = [[("a", "old", 1, place(1, 5)), ("b", "x", 1, place(1, 1))], [("a", "side later", 1, place(1, 6))], [("a", "side before", 1, place(1, 4))],
               [("b", "same", 1, place(1, 1))], [("c", "y", 3, place(3, 3))], [("c", "earlier", 2, place(9, 9))]]
    for n, rows in enumerate(batches):
        full = T.StructType([*schema.fields, T.StructField("versions", T.ArrayType(schemas.CHANGE_ORDER))])
        df = spark.createDataFrame(rows, full).withColumn("batch_id", F.lit(n).cast("long"))
        upsert_table(path, schema, every=2, buckets=3).add(df, n)
    got = read_upserts(spark, path, schema, every=2, buckets=3)
    assert rows_of(got) == [("a", "side later", 1), ("b", "same", 1), ("c", "y", 3)]


def test_a_small_batch_reads_only_its_buckets_of_first_visits(spark, pages, tmp_path):
    state = str(tmp_path / "visits")
    many = pages(*[(f"m{i}", "s", "1", "home", T0) for i in range(300)])
    repair_batch(many, 0, state).collect()
    visits_table(state).compact(spark, 0)
    few = pages(("m1", "s", "1", "home", T0 + DAY), ("m1", "s", "0", "home", T0 + DAY), ("new", "s", "1", "home", T0 + DAY))
    repaired = repair_batch(few, 1, state)
    assert rows_of(repaired, F.col("common")["mid"], F.col("common")["is_new"]) == [("m1", "0"), ("m1", "0"), ("new", "1")]
    table = visits_table(state)
    touched = {r[0] for r in spark.createDataFrame([("m1",), ("new",)], "mid string").select(table.bucket()).collect()}
    files = table.read(spark, buckets=sorted(touched)).inputFiles()
    assert {int(re.search(r"bucket=(\d+)", f)[1]) for f in files} == touched and len(touched) <= 2
    read = [f for f in repaired.inputFiles() if "/rows/" in f]
    assert read and {int(re.search(r"bucket=(\d+)", f)[1]) for f in read} <= touched
    assert table.read(spark).count() == 301
