"""Stateful queries in a session as Spark makes it, whose workers do not have the package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import SMALL

REPO = Path(__file__).resolve().parents[1]
RUN = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from rillhouse.catalog import QUERIES

spark = SparkSession.builder.master("local[4]").config(map={
    "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": sys.argv[3]}).getOrCreate()
before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
live, static = (QUERIES[name](spark, sys.argv[2]) for name in (sys.argv[4], sys.argv[4].removeprefix("stream_")))
names = sorted(static.columns)
rows = [sorted(map(str, df.select(*names).collect())) for df in (live, static)]
assert sorted(live.columns) == names and rows[0] and rows[0] == rows[1], (len(rows[0]), len(rows[1]))
assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before  # other queries of the session keep theirs
"""


@pytest.mark.parametrize("name", ["stream_dws_traffic", "stream_dws_home_detail"])
def test_stateful_query_in_a_plain_session(tmp_path, name):
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYTHONPATH", "SPARK_", "PYSPARK_SUBMIT", "PYSPARK_GATEWAY"))}
    done = subprocess.run([sys.executable, "-c", RUN, str(REPO), SMALL, str(tmp_path / "shared"), name], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
