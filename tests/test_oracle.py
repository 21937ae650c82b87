"""Every registered query against its DuckDB twin on the sf0.001 tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tools.check_oracle import SPARK_TO_DUCK, TABLES, norm

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    s = pd.DataFrame([r.asDict(recursive=True) for r in sdf.collect()], columns=sdf.columns)
    oq = E.oracle_sql()
    if name not in oq:
        assert len(s) > 0
        return
    rel = con.sql(oq[name])
    o = pd.DataFrame(rel.fetchall(), columns=rel.columns)
    assert sorted(s.columns) == sorted(o.columns)
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in sdf.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) \
            == types[f.name], f.name
    assert len(s) == len(o)
    assert norm(s) == norm(o)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 7
