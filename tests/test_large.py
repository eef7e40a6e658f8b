"""Plans and shapes that keep large input within bounds: what is broadcast, written out and repeated."""

from conftest import rows_of
from pyspark.sql import functions as F
from test_facts import order_feed

from rillhouse.functions.records import pack_texts, unpack_texts
from rillhouse.plans import facts as PF
from rillhouse.sources import testfeeds as X


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_packed_texts_come_back_as_they_were(spark):
    rows = [("1", 'a "quoted", [b]', None, "ä\n\t\\u0041 {"), ("2", None, None, None), ("3", "", "null", " ")]
    df = spark.createDataFrame(rows, "id string, a string, b string, c string")
    got = unpack_texts(df.select("id", pack_texts("a", "b", "c").alias("p")), "p", ("a", "b", "c"))
    assert rows_of(got) == rows_of(df)


def test_a_table_of_many_row_groups_is_read_as_it_lies(spark, tmp_path):
    rows = spark.range(40_000).withColumn("v", F.concat(F.lit("x"), F.col("id"))).coalesce(1)
    small = rows.write.option("parquet.block.size", "40000").option("parquet.page.size", "4000")
    small.option("parquet.page.size.row.check.min", "10").option("parquet.block.size.row.check.min", "10").parquet(str(tmp_path / "many.parquet"))
    rows.write.parquet(str(tmp_path / "one.parquet"))
    one, many = (X.table(spark, str(tmp_path), n) for n in ("one", "many"))
    assert "RoundRobin" in plan(one.limit(1)) and "RoundRobin" not in plan(many.limit(1))
    assert rows_of(one.agg(F.sum("id"))) == rows_of(many.agg(F.sum("id")))


def test_details_are_one_text_between_scan_and_result(changes):
    """Sorts and shuffles of the latest details carry a few columns, not one for each text."""
    found = plan(PF.dwd_order_detail(order_feed(changes)))
    assert "packed#" in found and "hashpartitioning(id" in found
    assert all("sku_name" not in line for line in found.splitlines() if "SortAggregate" in line or "Sort [" in line)


def test_payments_meet_details_where_these_lie(spark, changes, dic, monkeypatch):
    """Without orders of very many rows the payments' join deals no detail out again; with such, it spreads them over time."""
    paid = changes(*[("payment_info", "u", ts, {"payment_status": "1601"}, {"order_id": "o1", "payment_type": "1", "payment_status": "1602"})
                     for ts in (1_000, 10**9)])
    feed = order_feed(changes).unionByName(paid)

    def job():
        return PF.dwd_pay_suc(feed, PF.dwd_order_detail(feed), dic, before_ms=10**13, after_ms=10**13)

    plain = job()
    assert "bucket" not in plan(plain) and "Exchange hashpartitioning(order_id" in plan(plain)
    monkeypatch.setattr(PF, "hot_keys", lambda df, key: df.select(key))
    spread = job()
    assert "bucket" in plan(spread) and rows_of(spread) == rows_of(plain) != []
