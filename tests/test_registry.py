"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as se  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from strata.plans.adapters import TABLES  # noqa: E402

from conftest import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.columns == ["month", "gmv", "order_count", "aov"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(se.queries()))
def test_query_matches_oracle(spark, duck, name):
    sdf = se.queries()[name](spark, SF_SMALL).toPandas()
    sql = se.oracle_sql().get(name)
    if sql is None:
        assert len(sdf) >= 0
        return
    ddf = duck.sql(sql).df()
    sc, sr = rows_of(sdf)
    dc, dr = rows_of(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
