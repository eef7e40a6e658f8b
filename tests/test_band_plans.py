"""Plans of joins in a band of time on static input."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_facts import order_feed
from test_large import plan

from rillhouse.operators.bands import band_join
from rillhouse.plans import bands
from rillhouse.plans import facts as PF


@pytest.mark.parametrize("rows", [lambda c: PF.dwd_order_detail(c, band_ms=5_000),
                                  lambda c: bands.unmatched(bands.order_details(c, band_ms=5_000))])
def test_static_band_joins_broadcast_and_repeat_nothing(changes, rows):
    """However few bytes a side is estimated at, its rows do not pass through the driver, nor once for each salt."""
    found = plan(rows(order_feed(changes)))
    assert "SortMergeJoin" in found and "Broadcast" not in found and "Generate" not in found


def test_band_joins_without_skew_splitting_are_salted(spark):
    left = spark.createDataFrame([(f"k{i % 3}", i) for i in range(40)], "id string, ms long").select("id", F.timestamp_millis("ms").alias("et"))
    right = spark.createDataFrame([("k0", 5), ("k1", 6)], "id string, ms long").select("id", F.timestamp_millis("ms").alias("r_et"), F.lit(1).alias("x"))
    want = rows_of(band_join(left, right, "id", 4, 4, "left", salts=8))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        got = band_join(left, right, "id", 4, 4, "left", salts=8)
        assert "Generate" in plan(got) and rows_of(got) == want != []
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
