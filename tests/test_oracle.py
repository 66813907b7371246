"""Registered queries against their DuckDB oracles on the smallest driver tables.

A representative subset runs by default; QUAYSIDE_FULL_ORACLE=1 runs all of them.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import rows  # noqa: E402
from quayside.registry import ALL_QUERIES as QUERIES  # noqa: E402
from quayside.sources.tpch import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
SUBSET = ["revenue_summary", "dim_customers", "restaurant_performance", "cuisine_revenue", "merge_upsert",
          "change_classes", "dq_metrics", "scalar_battery", "order_pricing", "ctas_aggregate"]
NAMES = sorted(QUERIES) if os.environ.get("QUAYSIDE_FULL_ORACLE") else SUBSET


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "gmv_growth_pct" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    spark_cols, spark_rows = rows(E.queries()[name](spark, SF).toPandas())
    ora_cols, ora_rows = rows(con.execute(E.oracle_sql()[name]).df())
    assert spark_cols == ora_cols
    assert spark_rows == ora_rows
