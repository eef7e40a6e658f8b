"""Time the warehouse jobs on one data folder and print one JSON line.

Each query runs once to warm up and is then timed over a full run whose rows are all produced and
thrown away: ``queries``, whose times include deriving the change feed from the test tables. ``landed`` times the
fact jobs alone, on change records that lie in files by source table, as the landing job leaves them.
``BENCH_SF_DIR`` names the folder, ``BENCH_CPUS`` the number of threads.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rillhouse.catalog import DETAIL_TABLES, QUERIES
from rillhouse.plans import facts
from rillhouse.session import build_session, shared_dir
from rillhouse.sources import feeds, testfeeds

HEADLINE = ("ods_ingest", "dim_sync", "dwd_base_log", "dwd_base_db", "dwd_comment", "dwd_cart_add", "dwd_order_detail",
            "dwd_order_cancel", "dwd_pay_suc", "dwd_refund", "dws_keyword", "dws_traffic", "dws_home_detail")
LANDED = (*DETAIL_TABLES, "payment_info", "order_refund_info", "comment_info", "cart_info")


def timed(df: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    df().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def land(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """Writes the feed's lines by table and day; not timed."""
    path = f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}"
    lines = testfeeds.json_lines(testfeeds.change_feed(spark, folder, *LANDED))
    rows = feeds.ods_records(lines).repartition("source_table", "day")
    rows.write.partitionBy("source_table", "day").parquet(path)
    return feeds.ods_tables(spark, path)


def landed_jobs(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    feed, dic = land(spark, folder), testfeeds.base_dic(spark, folder)
    return {
        "dwd_comment": lambda: facts.dwd_comment(feed, dic), "dwd_cart_add": lambda: facts.dwd_cart_add(feed),
        "dwd_order_detail": lambda: facts.dwd_order_detail(feed), "dwd_order_cancel": lambda: facts.dwd_order_cancel(feed),
        "dwd_pay_suc": lambda: facts.dwd_pay_suc(feed, facts.dwd_order_detail(feed), dic), "dwd_refund": lambda: facts.dwd_refund(feed, dic),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    cold = {n: timed(lambda n=n: QUERIES[n](spark, folder)) for n in names}
    warm = {n: timed(lambda n=n: QUERIES[n](spark, folder)) for n in names}
    jobs = {n: job for n, job in landed_jobs(spark, folder).items() if n in names}
    for job in jobs.values():
        timed(job)
    landed = {n: timed(job) for n, job in jobs.items()}
    spark.stop()
    print(json.dumps({"metric": "warehouse_jobs_total", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "cold": cold, "landed": landed, "landed_total": round(sum(landed.values()), 3),
                      "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
