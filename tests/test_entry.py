"""Driver contract: entry smoke, registry coverage, and every query against
its DuckDB oracle (row count, column names and types, exact values)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from towerlens.plans.registry import ORACLE, QUERIES

from .conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem"]
ROWS_ONLY: set[str] = set()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].total_customers > 0


def test_every_query_has_oracle_or_is_declared_rows_only():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(q) and set(ORACLE) <= set(o)
    assert set(QUERIES) - set(o) == ROWS_ONLY


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def canon(df: pd.DataFrame):
    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "<null>"
        return repr(v.item() if hasattr(v, "item") else v)
    cols = sorted(df.columns)
    return sorted(tuple(norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sat = entry.queries()[name](spark, SF_SMALL).toArrow()
    oat = duck.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert sat.num_rows == oat.num_rows
    assert {f.name: str(f.type) for f in sat.schema} == {f.name: str(f.type) for f in oat.schema}
    assert canon(sat.to_pandas()) == canon(oat.to_pandas())


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF_SMALL).count() == 1
