"""Every registered query against its DuckDB oracle (the driver's correctness gate), at the
smallest scale factor so the suite stays quick; tools/compare.py runs the same at sf0.01."""

import duckdb
import pytest

import __spark_entry__ as ent
from alpina.plans.registry import QUERIES, load_all
from tools.compare import TABLES, duck_rows, key, spark_rows

from conftest import SF001

load_all()
NAMES = sorted(QUERIES)
ORACLES = ent.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sc, st, sr = spark_rows(ent.queries()[name](spark, SF001))
    dc, dt, dr = duck_rows(con, ORACLES[name])
    assert sc == dc
    assert {c: st[c] for c in sc} == {c: dt[c] for c in dc}
    assert len(sr) == len(dr)
    assert sorted(sr, key=key) == sorted(dr, key=key)


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert "slope_p90" in df.columns
