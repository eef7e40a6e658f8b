import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rillhouse import schemas  # noqa: E402
from rillhouse.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def changes(spark):
    """Change records from (table, op, ts_ms, before, after); the position is the row's number."""
    def make(*rows):
        data = [(b, a, {"db": "shop", "table": t, "pos": str(i)}, op, ts)
                for i, (t, op, ts, b, a) in enumerate(rows)]
        return spark.createDataFrame(data, schemas.CHANGE)
    return make


@pytest.fixture
def dic(spark):
    return spark.createDataFrame([("1", ("one",)), ("2", ("two",))], schemas.BASE_DIC)


@pytest.fixture
def pages(spark):
    """Page views from (mid, sid, is_new, page_id, ts)."""
    def make(*rows):
        data = [((m, n, "v1", "app", "a", s), (p, "home", None, None, 10), ts, i)
                for i, (m, s, n, p, ts) in enumerate(rows)]
        from pyspark.sql import types as T
        schema = T.StructType([*schemas.PAGE_LOG_TYPED.fields, T.StructField("id", T.LongType())])
        return spark.createDataFrame(data, schema)
    return make


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
