"""Every registered query against its SQL in DuckDB, on whole tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import bench
import duckdb_checks

DATA = Path("/root/testdata")
QUERIES = entry.reference_queries()
ORACLE = duckdb_checks.statements()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def _duck(sf_dir, sql):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    result = con.sql(sql)
    return result.columns, result.fetchall()


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(row[i] for i in order) for row in rows]
    nulls_last = lambda row: [(v is None, 0 if v is None else v) for v in row]
    return sorted(columns), sorted(rows, key=nulls_last)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, name, sf):
    sf_dir = str(DATA / sf)
    df = QUERIES[name](spark, sf_dir)
    got = _sorted(df.columns, [tuple(row) for row in df.collect()])
    want = _sorted(*_duck(sf_dir, ORACLE[name]))
    assert got[0] == want[0]
    assert len(got[1]) > 0
    assert got[1] == want[1]


def test_entry(spark):
    assert entry.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(bench.UNFUSED))
def test_unfused_shape_gives_the_same(spark, name):
    sf_dir = str(DATA / "sf0.01")
    frames = [queries[name](spark, sf_dir) for queries in (QUERIES, bench.UNFUSED)]
    fused, unfused = (_sorted(df.columns, df.collect()) for df in frames)
    assert fused == unfused
