"""Every registered query with an oracle matches DuckDB on the sf0.001 tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from attrition.sources.tables import TABLES
from tests.conftest import SF_SMALL

ORACLES = entry.oracle_sql()


def _canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return "inf" if v == math.inf else "-inf" if v == -math.inf else f"{v:.9g}"
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    srows = sorted("|".join(_canon(r[c]) for c in cols) for r in df.collect())
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    drows = sorted("|".join(_canon(dict(zip(dcols, r))[c]) for c in cols) for r in res.fetchall())
    assert srows == drows


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "churn_rate" in df.columns
