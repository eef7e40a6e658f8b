import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from rillhouse.operators.skew import hot_keys, is_small, join_hot_split, join_small
from rillhouse.operators.upsert import upsert_latest


def skewed(spark, n=60_000):
    """One key holds a third of all rows, one in a thousand has none."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 1000 != 1, F.concat(F.lit("k"), (i % 7000).cast("string")))
    return spark.range(n).select(key.alias("k"), "id")


def settings(spark, **values):
    """Sets Spark SQL settings and gives what they were."""
    names = {f"spark.sql.{n.replace('__', '.')}": v for n, v in values.items()}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    return before


def put_back(spark, before):
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.fixture
def plain(spark):
    """Eight shuffle partitions that stay as they are, without adaptive execution."""
    before = settings(spark, shuffle__partitions="8", adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    yield
    put_back(spark, before)


@pytest.fixture
def adaptive(spark):
    """Adaptive execution for small data: partitions of 64 kB are large."""
    before = settings(spark, shuffle__partitions="8", adaptive__enabled="true", autoBroadcastJoinThreshold="-1",
                      adaptive__skewJoin__skewedPartitionThresholdInBytes="65536", adaptive__skewJoin__skewedPartitionFactor="2.0",
                      adaptive__advisoryPartitionSizeInBytes="32768")
    yield
    put_back(spark, before)


def test_only_keys_with_many_rows_are_hot(spark):
    df = skewed(spark)
    assert rows_of(hot_keys(df, "k", rows=1)) == [("hot",)] == rows_of(hot_keys(df, "k"))
    assert hot_keys(df, "k", rows=20_001).count() == 0
    assert hot_keys(df, "k", share=0.5).count() == 0
    assert hot_keys(df.where("false"), "k").count() == 0


def test_split_join_equals_plain_join(spark, plain):
    left = skewed(spark)
    right = left.where("k is not null").groupBy("k").agg(F.max("id").alias("m")).where("k <> 'k17'")
    for how in ("inner", "left"):
        got, want = join_hot_split(left, right, "k", how), left.join(right, "k", how)
        assert got.columns == want.columns and "join_salt" in got._jdf.queryExecution().optimizedPlan().toString()
        assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == want.count()


def test_maps_count_for_the_split(spark, plain):
    """Rows that differ in a map alone are still dealt apart; columns that hold maps deeper are left out."""
    left = skewed(spark).select("k", F.create_map(F.lit("i"), F.col("id").cast("string")).alias("m"),
                                F.array(F.create_map(F.lit("x"), F.lit("y"))).alias("deep"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    assert join_hot_split(left, right, "k").count() == 20_000


def test_rows_of_a_hot_key_are_spread_and_sides_planned_once(spark, plain, tmp_path):
    """A third of the rows on one key: no task of the join gets more than a fifth, and each side is read once."""
    skewed(spark).write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    spark.range(7000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).unionAll(
        spark.createDataFrame([("hot", 0)], "k string, v long")).write.parquet(str(tmp_path / "right"))
    right = spark.read.parquet(str(tmp_path / "right"))

    def largest(joined):
        return max(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())

    whole, split = left.join(right, "k"), join_hot_split(left, right, "k")
    assert split.count() == whole.count()
    assert largest(whole) > 20_000 and largest(split) < 12_000
    split.collect()
    final = split._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2


def test_adaptive_execution_splits_the_hot_key(spark, adaptive, tmp_path):
    """The final plan of details of which a third belong to one order: the join is marked as split, each side is read once."""
    skewed(spark).select("k", "id", F.sha2(F.col("id").cast("string"), 256).alias("more")).repartition(16).write.parquet(str(tmp_path / "left"))
    spark.range(7000).select(F.concat(F.lit("k"), "id").alias("k")).unionAll(
        spark.createDataFrame([("hot",)], "k string")).write.parquet(str(tmp_path / "right"))
    joined = join_hot_split(spark.read.parquet(str(tmp_path / "left")), spark.read.parquet(str(tmp_path / "right")), "k")
    rows = joined.collect()
    final = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "skew=true" in final and final.count("FileScan parquet") == 2
    assert sum(r["k"] == "hot" for r in rows) == 20_000


def test_without_hot_keys_the_join_is_plain(spark, plain):
    left = skewed(spark).where("k <> 'hot'")
    right = left.groupBy("k").agg(F.max("id").alias("m"))
    plan = join_hot_split(left, right, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "join_salt" not in plan and plan.count("Join") == 1


def test_upsert_takes_the_last_row(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), ("b", 1, "z")], "id string, ts long, v string")
    assert rows_of(upsert_latest(df, ["id"], F.col("ts"))) == [("a", 3, None), ("b", 1, "z")]


def test_small_tables_are_broadcast_only_when_small(spark):
    left = skewed(spark, 6000).withColumn("j", F.col("id") % 2)
    right = left.where("k is not null").groupBy("k", "j").agg(F.max("id").alias("m"))
    one = right.groupBy("k").agg(F.max("m").alias("m"))
    for keys, table in ((["k"], one), (["k", "j"], right)):
        want = left.join(table, keys, "left")
        for limit in (10, 100_000):
            got = join_small(left, table, keys, "left", max_rows=limit)
            assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()
    plan = join_small(left, one, ["k"], max_rows=10)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert "strategy=broadcast" in join_small(left, one, ["k"])._jdf.queryExecution().optimizedPlan().toString()


def test_few_rows_of_many_bytes_are_not_broadcast(spark):
    wide = spark.range(3).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("x"), 1000).alias("v"))
    assert is_small(wide) and not is_small(wide, max_bytes=2999) and not is_small(wide, max_rows=2)
    assert is_small(wide.limit(0), 0, 0)
