"""The registered queries: their SQL, their plans and their columns."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from monthlens.llm import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def test_all_are_registered():
    names = [name.split("_")[0] for name in queries.queries()]
    assert names == [f"op{n}" for n in range(1, 14)]
    assert {*queries.queries(), "pipeline"} <= set(entry.queries())
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, str(DATA)).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("name", ["op5_license_scan", "op6_chat_format", "op10_secret_scan", "op11_merkle_manifest"])
def test_native_plans_run_no_python(spark, name):
    plan = queries.queries()[name](spark, str(DATA))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow", "CartesianProduct"))
