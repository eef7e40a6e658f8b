"""Every catalog query against its SQL."""

import duckdb
import pytest
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, bag


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    df = queries()[name](spark, SMALL)
    cursor = db.execute(oracle_sql()[name])
    want = bag([c[0] for c in cursor.description], cursor.fetchall())
    assert bag(df.columns, df.collect()) == want
    assert want[0]


def test_entry(spark):
    assert entry(spark).count() > 0
