"""Every registered query against its DuckDB oracle (sf0.001); rows-only queries must run."""

import math

import duckdb
import pytest

from tidewater.plans.catalog import load_all
from tidewater.plans.tables import BASE_TABLES

SF = "/root/testdata/sf0.001"
REG = load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _close(a, b):
    for x, y in zip(a, b):
        if isinstance(x, float) and isinstance(y, float):
            if not math.isclose(x, y, rel_tol=1e-7, abs_tol=1e-9):
                return False
        elif isinstance(x, (int, float)) and isinstance(y, (int, float)):
            if not math.isclose(float(x), float(y), rel_tol=1e-9):
                return False
        elif x != y:
            return False
    return True


def _key(row):
    return repr(tuple(float(f"{v:.4g}") if isinstance(v, float) and v == v else v for v in row))


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, con, name):
    q = REG[name]
    df = q.spark_df(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    rows = df.collect()
    sql = q.oracle()
    if sql is None:
        assert df.columns
        return
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    s = sorted((tuple(_norm(r[df.columns.index(c)]) for c in order) for r in rows), key=_key)
    d = sorted((tuple(_norm(r[cols.index(c)]) for c in order) for r in res.fetchall()), key=_key)
    assert len(s) == len(d)
    bad = [(a, b) for a, b in zip(s, d) if not _close(a, b)]
    assert not bad, bad[:3]
