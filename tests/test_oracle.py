"""Every registered query against its DuckDB oracle on the sf0.001 tables:
row count, column names and an order-insensitive hash of the values."""
import duckdb
import pytest

import __spark_entry__ as E
from layerflow.plans.catalog import QUERIES
from layerflow.plans.oracle import ORACLE
from tools.compare import TABLES, digest


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "review_id" in df.columns
