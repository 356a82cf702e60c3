"""What the physical plans must and must not hold."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
import fixtures as fx
from monthlens import jobs
from monthlens.operators import usersets
from monthlens.plans import activity, clients, month_stat, stored_stat
from monthlens.sources import tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _query(spark, name):
    return _plan(entry.queries()[name](spark, SF))


def _count(plan, node):
    return len(re.findall(rf"(?<![A-Za-z]){node}\b", plan))


@pytest.mark.parametrize("name", sorted(entry.reference_queries()))
def test_no_pairwise_join_no_python_rows(spark, name):
    plan = _query(spark, name)
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ExistingRDD"):
        assert node not in plan


def test_month_statistic_reads_each_input_once(spark):
    plan = _query(spark, "month_user_stat")
    assert _count(plan, "FileScan") == 2
    # Registrations per user (of the test tables), marks per user, one row, the rest days.
    assert _count(plan, "Exchange") == 4
    assert "GreaterThanOrEqual(o_orderdate,1996-02-01T00:00)" in plan
    assert "LessThan(o_orderdate,1996-04-01T00:00)" in plan


def test_all_months_read_each_input_once(spark):
    plan = _query(spark, "month_user_stat_all")
    assert _count(plan, "FileScan") == 2


def test_every_scan_takes_its_columns_only(spark):
    plan = _query(spark, "mau")
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_client_version_is_one_scan_and_one_shuffle(spark):
    for name in ("client_version", "client_by_source", "latest_client"):
        plan = _query(spark, name)
        assert _count(plan, "FileScan") == 1
        assert _count(plan, "Exchange") == 1
        assert "Join" not in plan
    share = _query(spark, "month_client_version")
    assert _count(share, "Exchange") == 2  # per user, and the single row of totals


def test_latest_client_drops_rows_before_the_shuffle(spark):
    plan = _query(spark, "latest_client")
    assert _count(plan, "WindowGroupLimit") == 2


def test_ranks_of_a_small_table_are_one_shuffle(spark):
    plan = _query(spark, "client_ranks")
    assert _count(plan, "Exchange") == 1
    assert "Join" not in plan


def test_ranks_by_range_join_a_short_list_only(spark):
    plan = _query(spark, "client_ranks_by_range")
    assert _count(plan, "BroadcastHashJoin") == 1
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_logins_are_read_once_while_they_are_written(spark, tmp_path, monkeypatch):
    """The malformed days are counted in the pass that writes the month."""
    paths = {name: str(tmp_path / name) for name in ("records", "blocks", "logins")}
    fx.records(spark).write.parquet(paths["records"])
    fx.blocks(spark, [("aa", 0, 2**32 - 1)]).write.parquet(paths["blocks"])
    written = []
    overwrite = jobs.out.overwrite_month
    monkeypatch.setattr(
        jobs.out, "overwrite_month", lambda df, *a, **k: written.append(df) or overwrite(df, *a, **k)
    )
    assert jobs.load_logins(spark, fx.MARCH, *paths.values()) == 0
    plan = _plan(written[0])
    assert plan.count(paths["records"]) == 1
    assert _count(plan, "CollectMetrics") == 1


def test_stored_sets_are_read_pruned(spark, tmp_path):
    path = str(tmp_path / "sets")
    sets = usersets.signup_sets(fx.users(spark), "UTC")
    sets.write.parquet(path)
    plan = _plan(stored_stat.mau(spark.read.parquet(path), fx.MARCH))
    assert _count(plan, "FileScan") == 1
    assert "ReadSchema: struct<kind:string,label:string,bucket:bigint,bits:binary" in plan


def test_snapshot_is_pruned_by_partition_and_by_time(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    rows = [(fx.BASE, 1, "2024-02"), (fx.BASE, 2, "2024-04")]
    spark.createDataFrame(rows, "id bigint, created_at bigint, ds string").write.partitionBy(
        "ds"
    ).parquet(path)
    visits = tables.visits_from_records(fx.records(spark), fx.MARCH)
    signups = tables.read_partitioned(spark, path, "ds")
    stat = month_stat.month_user_stat(visits, signups, fx.rest_days(spark), fx.MARCH)
    plan = _plan(stat)
    assert re.search(r"PartitionFilters: \[[^\]]*ds#\d+ < 2024-04", plan)
    start, end = (fx.MARCH.millis(d) for d in (fx.MARCH.previous, fx.MARCH.following))
    assert f"GreaterThanOrEqual(created_at,{start})" in plan
    assert f"LessThan(created_at,{end})" in plan


def test_all_months_read_registrations_once(spark, tmp_path):
    path = str(tmp_path / "users")
    fx.users(spark).write.parquet(path)
    visits = tables.visits_from_records(fx.records(spark), fx.MARCH)
    stat = month_stat.month_user_stat_all(
        visits, spark.read.parquet(path), fx.rest_days(spark), fx.MARCH
    )
    assert _count(_plan(stat), "FileScan") == 1


def test_address_lookup_is_two_hash_joins(spark):
    plan = _query(spark, "ip_country")
    assert _count(plan, "BroadcastHashJoin") == 2
    assert _count(plan, "Exchange") == 0


def test_text_dates_reach_the_reader(spark, tmp_path):
    path = str(tmp_path / "logins")
    spark.createDataFrame(
        [(1, "2024-03-01", "2024-03"), (1, "2024-01-01", "2024-01")],
        "uid bigint, day_time string, month_time string",
    ).write.partitionBy("month_time").parquet(path)
    table = tables.read_table(
        spark, path, "uid bigint, day_time string, month_time string"
    )
    visits = tables.visits_from_logins(table, fx.MARCH.previous, fx.MARCH.following)
    plan = _plan(activity.mau(visits, fx.MARCH))
    assert "GreaterThanOrEqual(day_time,2024-02), LessThan(day_time,2024-04)" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*month_time#\d+ <= 2024-03", plan)
    installs = str(tmp_path / "installs")
    fx.install_frame(spark, [("client", 1, 1, "1", "2024-03-01 00:00:00", "c")]).write.parquet(
        installs
    )
    plan = _plan(clients.client_version(spark.read.parquet(installs), fx.MARCH))
    assert "LessThan(created_at,2024-04)" in plan
