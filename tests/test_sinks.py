"""Output tables, reports and the whole chain of jobs."""

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from monthlens import MonthParams, jobs
from monthlens.__main__ import JOBS, main
from monthlens.plans import clients, month_stat
from monthlens.sinks import reports, tables as out
from monthlens.sources import tables as src

FEBRUARY = MonthParams.for_month("2024-02")


def _shares(spark, number=1):
    return spark.createDataFrame([("ios", number, 4, number / 4)], out.MONTH_CLIENT_VERSION)


def _text(path):
    (part,) = path.glob("part-*")
    return part.read_text()


def test_schema_is_created_once(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = out.by_month(out.MONTH_CLIENT_VERSION)
    out.create_if_missing(spark, path, schema, "ds")
    assert src.read_table(spark, path, schema).count() == 0
    out.overwrite_month(_shares(spark), path, out.MONTH_CLIENT_VERSION, "2024-03")
    out.create_if_missing(spark, path, schema, "ds")
    table = src.read_table(spark, path, schema)
    assert table.count() == 1
    assert table.schema.simpleString() == schema.simpleString()


def test_months_are_replaced_one_at_a_time(spark, tmp_path):
    path = str(tmp_path / "t")
    for number, ds in ((1, "2024-02"), (2, "2024-03"), (3, "2024-03")):
        written = out.overwrite_month(_shares(spark, number), path, out.MONTH_CLIENT_VERSION, ds)
        assert written == 1
    table = src.read_table(spark, path, out.by_month(out.MONTH_CLIENT_VERSION))
    assert {(r.ds, r.number) for r in table.collect()} == {("2024-02", 1), ("2024-03", 3)}


def test_an_empty_month_is_refused_and_replaces_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    out.overwrite_month(_shares(spark), path, out.MONTH_CLIENT_VERSION, "2024-03")
    with pytest.raises(ValueError, match="nothing to write"):
        out.overwrite_month(
            _shares(spark).where("number < 0"), path, out.MONTH_CLIENT_VERSION, "2024-03"
        )
    assert out.read_month(spark, path, out.MONTH_CLIENT_VERSION, "2024-03").count() == 1


def test_other_columns_or_types_are_refused(spark):
    with pytest.raises(ValueError, match="ratio is missing"):
        out.conform(_shares(spark).drop("ratio"), out.MONTH_CLIENT_VERSION)
    wrong = _shares(spark).withColumn("number", F.col("number").cast("int"))
    with pytest.raises(ValueError, match="number"):
        out.conform(wrong, out.MONTH_CLIENT_VERSION)


def test_results_have_the_declared_columns(spark):
    visits = src.visits_from_records(
        fx.records(spark), fx.MARCH, fx.MARCH.previous, fx.MARCH.following
    )
    stat = month_stat.month_user_stat(visits, fx.users(spark), fx.rest_days(spark), fx.MARCH)
    installs = src.installs(fx.device_installs(spark), fx.client_installs(spark))
    merged = clients.client_version(installs, fx.MARCH)
    for df, schema in (
        (stat, out.MONTH_USER_STAT),
        (merged, out.CLIENT_VERSION),
        (clients.month_client_version(merged), out.MONTH_CLIENT_VERSION),
    ):
        assert df.columns == schema.fieldNames()
        out.conform(df, schema)


def test_report_text(spark, tmp_path):
    row = spark.createDataFrame(
        [("2024-03", 5, 5, 3, 2, None, 2 / 3, None)], out.MONTH_USER_STAT
    )
    reports.write_report(month_stat.active_user_stat(row), str(tmp_path / "r"))
    assert _text(tmp_path / "r") == (
        "month_time\tregister_number\tmau\tmau_exclude_register\texchange_dau\t"
        "non_exchange_dau\tkeep_ratio\tnew_user_keep_ratio\n"
        "2024-03\t5\t5\t3\t2\tNULL\t0.6667\tNULL\n"
    )


def _inputs(spark, root):
    frames = {
        "users": fx.users(spark),
        "records": fx.records(spark),
        "rest": fx.rest_days(spark),
        "blocks": fx.blocks(spark, [("aa", 10 << 24, (11 << 24) - 1)]),
        "device": fx.device_installs(spark),
        "client": fx.client_installs(spark),
    }
    paths = {name: str(root / name) for name in frames}
    for name, df in frames.items():
        df.write.parquet(paths[name])
    return paths


def test_chain_of_jobs(spark, tmp_path):
    at = _inputs(spark, tmp_path)
    for name in ("snapshot", "logins", "stat", "clients", "share", "user_r", "client_r"):
        at[name] = str(tmp_path / name)
    months = [MonthParams.for_month(m) for m in ("2024-01", "2024-02", "2024-03", "2024-04")]
    for p in months:
        jobs.load_users(spark, p, at["users"], at["snapshot"])
    for p in months[1:]:
        jobs.load_logins(spark, p, at["records"], at["blocks"], at["logins"])
    logins = src.read_table(spark, at["logins"], out.LOGIN_ETL)
    assert {r.city for r in logins.collect()} == {"aa"}
    for p in (FEBRUARY, fx.MARCH, fx.MARCH):
        jobs.user_stat(spark, p, at["logins"], at["snapshot"], at["rest"], at["stat"])
    stat = out.read_month(spark, at["stat"], out.MONTH_USER_STAT, "2024-03")
    assert stat.drop("ds").first().asDict() == fx.STAT
    february = out.read_month(spark, at["stat"], out.MONTH_USER_STAT, "2024-02").first()
    assert (february.register_number, february.mau, february.keep_ratio) == (3, 4, None)
    jobs.user_report(spark, fx.MARCH, at["stat"], at["user_r"])
    assert _text(tmp_path / "user_r").splitlines()[1] == "2024-03\t5\t5\t3\t2\t1\t0.75\t0.5"

    for _ in range(2):
        jobs.client_version(spark, fx.MARCH, at["device"], at["client"], at["clients"])
    table = out.read_as_of(spark, at["clients"], out.CLIENT_VERSION, "2024-03")
    assert sorted(map(tuple, table.collect()), key=repr) == sorted(fx.CLIENTS, key=repr)
    jobs.client_share(spark, fx.MARCH, at["clients"], at["share"])
    jobs.client_report(spark, fx.MARCH, at["share"], at["client_r"])
    lines = _text(tmp_path / "client_r").splitlines()
    assert lines[0] == "ds\tmobile_type\tnumber\ttotal\tratio"
    assert sorted(lines[1:]) == [
        "2024-03\tandroid\t2\t4\t0.5",
        "2024-03\tboth\t1\t4\t0.25",
        "2024-03\tios\t3\t4\t0.75",
    ]


def test_failed_run_leaves_the_client_table(spark, tmp_path):
    path = str(tmp_path / "clients")
    good = spark.createDataFrame(fx.CLIENTS, out.CLIENT_VERSION)
    out.overwrite_as_of(good, path, out.CLIENT_VERSION, "2024-03")
    broken = good.withColumn(
        "uid", F.when(F.col("uid") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("uid"))
    )
    for ds in ("2024-03", "2024-04"):
        with pytest.raises(Exception, match="broken"):
            out.overwrite_as_of(broken, path, out.CLIENT_VERSION, ds)
    rows = out.read_as_of(spark, path, out.CLIENT_VERSION, "2024-03").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(fx.CLIENTS, key=repr)
    out.overwrite_as_of(good.limit(1), path, out.CLIENT_VERSION, "2024-03")
    assert out.read_as_of(spark, path, out.CLIENT_VERSION, "2024-03").count() == 1


def test_shares_need_the_table_as_of_their_month(spark, tmp_path):
    at = _inputs(spark, tmp_path)
    table, share = str(tmp_path / "clients"), str(tmp_path / "share")
    jobs.client_version(spark, fx.MARCH, at["device"], at["client"], table)
    with pytest.raises(ValueError, match="as of 2024-01"):
        jobs.client_share(spark, MonthParams.for_month("2024-01"), table, share)


def test_jobs_report_what_is_malformed(spark, tmp_path, caplog):
    at = _inputs(spark, tmp_path)
    texts = ["2024-03-00 10:00:00", "2024-03", "2024-13-05", "2024-03-xx", "2024-03-01 08:00:00"]
    odd = fx.records(spark, [(fx.BASE + i, t, "10.0.0.1") for i, t in enumerate(texts)])
    odd.write.parquet(str(tmp_path / "odd"))
    logins, snapshot = str(tmp_path / "logins"), str(tmp_path / "snapshot")
    assert jobs.load_logins(spark, fx.MARCH, str(tmp_path / "odd"), at["blocks"], logins) == 3
    rows = src.read_table(spark, logins, out.LOGIN_ETL).collect()
    assert {r.month_time for r in rows} == {"2024-03"}
    assert {r.uid - fx.BASE for r in rows} == {0, 1, 3, 4}
    users = [(fx.BASE + 1, fx.millis("2024-03-05"), "2024-03"), (None, fx.millis("2024-03-06"), "2024-03")]
    spark.createDataFrame(users, "id bigint, created_at bigint, ds string").write.partitionBy(
        "ds"
    ).parquet(snapshot)
    stat = str(tmp_path / "stat")
    assert jobs.user_stat(spark, fx.MARCH, logins, snapshot, at["rest"], stat) == 1
    row = out.read_month(spark, stat, out.MONTH_USER_STAT, "2024-03").first()
    assert (row.mau, row.mau_exclude_register, row.register_number) == (4, 0, 1)
    assert "3 logins have no day" in caplog.text
    assert "1 registrations have no id" in caplog.text


def test_command_line(spark, tmp_path):
    at = _inputs(spark, tmp_path)
    table = str(tmp_path / "clients")
    main(
        ["client-version", "--month", "2024-03", "--android-label", "A", "--iphone-label", "I"]
        + ["--device", at["device"], "--client", at["client"], "--table", table]
    )
    rows = out.read_as_of(spark, table, out.CLIENT_VERSION, "2024-03").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(fx.CLIENTS, key=repr)
    assert len(JOBS) == 15
