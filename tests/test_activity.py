"""The monthly statistic: golden values, brute force and properties."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from monthlens import MonthParams
from monthlens.functions.dates import month_of_millis
from monthlens.plans import activity, etl, month_stat
from monthlens.sources import tables


def _inputs(spark, params=fx.MARCH, records=None, users=None):
    visits = tables.visits_from_records(
        fx.records(spark, records or fx.RECORDS), params, params.previous, params.following
    )
    signups = tables.valid_ids(fx.users(spark, users or fx.USERS), "id", params)
    return visits, signups, fx.rest_days(spark)


def _row(df):
    (row,) = df.collect()
    return row.asDict()


def test_golden_month(spark):
    assert _row(month_stat.month_user_stat(*_inputs(spark), fx.MARCH)) == fx.STAT


def test_single_figures_agree_with_the_statistic(spark):
    visits, signups, rest = _inputs(spark)
    p = fx.MARCH
    for df in (
        activity.register_number(signups, p),
        activity.mau(visits, p),
        activity.mau_exclude_register(visits, signups, p),
        activity.exchange_dau(visits, rest, p),
        activity.non_exchange_dau(visits, rest, p),
    ):
        row = _row(df)
        assert row == {key: fx.STAT[key] for key in row}
    kept = _row(activity.keep_ratio(visits, p))
    assert (kept["numerator"], kept["denominator"], kept["keep_ratio"]) == (3, 4, 0.75)
    new = _row(activity.new_user_keep_ratio(visits, signups, p))
    assert (new["active_again"], new["register_number"], new["new_user_keep_ratio"]) == (1, 2, 0.5)
    assert _row(activity.register_number_month(signups, p))["register_number"] == 2


def test_daily_users(spark):
    days = {r.day_time: r.dau for r in activity.dau_by_day(_inputs(spark)[0], fx.MARCH).collect()}
    assert days == {
        "2024-03-01": 2,
        "2024-03-04": 3,
        "2024-03-05": 2,
        "2024-03-06": 3,
        "2024-03-09": 1,
    }


def test_all_months_hold_the_golden_month(spark):
    visits = tables.visits_from_records(fx.records(spark), fx.MARCH)
    _, signups, rest = _inputs(spark)
    rows = {
        r.month_time: r.asDict()
        for r in month_stat.month_user_stat_all(visits, signups, rest, fx.MARCH).collect()
    }
    assert sorted(rows) == ["2024-02", "2024-03", "2024-04"]
    assert rows["2024-03"] == fx.STAT
    assert rows["2024-02"]["keep_ratio"] is None
    assert rows["2024-04"]["register_number"] == 6


def test_month_without_any_row(spark):
    p = MonthParams.for_month("2020-01")
    row = _row(month_stat.month_user_stat(*_inputs(spark, p), p))
    assert row == {
        "month_time": "2020-01",
        "register_number": 0,
        "mau": 0,
        "mau_exclude_register": 0,
        "exchange_dau": None,
        "non_exchange_dau": None,
        "keep_ratio": None,
        "new_user_keep_ratio": None,
    }


def test_registration_without_id_follows_not_in(spark):
    visits, _, rest = _inputs(spark)
    signups = fx.users(spark, [*fx.USERS, (None, fx.millis("2024-03-20"))])
    row = _row(month_stat.month_user_stat(visits, signups, rest, fx.MARCH))
    assert row == {**fx.STAT, "mau_exclude_register": 0}
    visits.createOrReplaceTempView("v")
    signups.createOrReplaceTempView("s")
    literal = spark.sql(
        f"select count(distinct uid) as n from v where month = date'2024-03-01' and uid not in "
        f"(select id from s where created_at >= {fx.millis('2024-03-01')} "
        f"and created_at < {fx.millis('2024-04-01')})"
    )
    assert literal.first().n == 0


def test_visit_without_user_counts_nowhere(spark):
    visits, signups, rest = _inputs(spark)
    lost = visits.limit(1).select(F.lit(None).cast("bigint").alias("uid"), "month", "day")
    stat = month_stat.month_user_stat(visits.unionByName(lost), signups, rest, fx.MARCH)
    assert _row(stat) == fx.STAT


def test_repeated_registrations_and_rest_days_change_nothing(spark):
    visits, signups, rest = _inputs(spark)
    stat = month_stat.month_user_stat(
        visits, signups.unionByName(signups), rest.unionByName(rest), fx.MARCH
    )
    assert _row(stat) == fx.STAT


def test_malformed_day_counts_in_the_month_only(spark):
    records = [*fx.RECORDS, (fx.BASE + 11, "2024-03-xx 08:00:00", "10.0.0.1")]
    row = _row(month_stat.month_user_stat(*_inputs(spark, records=records), fx.MARCH))
    assert row == {**fx.STAT, "mau": 6, "mau_exclude_register": 4}
    assert tables.malformed_days(fx.records(spark, records), "recordtime").first().malformed == 1


def test_snapshot_partition_decides_who_is_registered(spark):
    visits, _, rest = _inputs(spark)
    signups = spark.createDataFrame(
        [(i, created, "2024-04" if i == fx.BASE + 1 else "2024-03") for i, created in fx.USERS],
        "id bigint, created_at bigint, ds string",
    )
    row = _row(month_stat.month_user_stat(visits, signups, rest, fx.MARCH))
    assert row == {**fx.STAT, "register_number": 6}
    assert _row(activity.register_number(signups, fx.MARCH))["register_number"] == 6


def test_time_zone_moves_month_edges(spark):
    # 2024-03-31 17:00 UTC is already April in Shanghai.
    edge = fx.users(spark, [(fx.BASE + 1, fx.millis("2024-03-31 17:00:00"))])
    shanghai = MonthParams.for_month("2024-04", time_zone="Asia/Shanghai")
    utc = MonthParams.for_month("2024-04")
    assert etl.user_snapshot_month(edge, shanghai).count() == 1
    assert etl.user_snapshot_month(edge, utc).count() == 0
    months = edge.select(
        month_of_millis("created_at", "Asia/Shanghai").alias("there"),
        month_of_millis("created_at", "UTC").alias("here"),
    ).first()
    assert (months.there, months.here) == (date(2024, 4, 1), date(2024, 3, 1))


def test_id_bounds_are_closed(spark):
    ids = [999_999_999, 1_000_000_000, 10_000_000_000, 10_000_000_001, None]
    users = fx.users(spark, [(i, fx.millis("2024-03-10")) for i in ids])
    kept = {r.id for r in etl.user_snapshot_month(users, fx.MARCH).collect()}
    assert kept == {1_000_000_000, 10_000_000_000}


def test_run_date_gives_last_month():
    assert MonthParams.run_on(date(2024, 1, 31)).label == "2023-12"
    assert MonthParams.run_on(date(2024, 4, 1)).previous == date(2024, 2, 1)


def _brute(records, users, rest, month):
    """The statistic with Python sets."""
    def shift(day, n):
        index = day.year * 12 + day.month - 1 + n
        return date(index // 12, index % 12 + 1, 1)

    start, end, before = month, shift(month, 1), shift(month, -1)
    now = {u for u, d in records if start <= d < end}
    prior = {u for u, d in records if before <= d < start}
    new = {u for u, d in users if start <= d < end}
    new_before = {u for u, d in users if before <= d < start}
    days = {}
    for u, d in records:
        if start <= d < end:
            days.setdefault(d, set()).add(u)
    trading = [len(v) for d, v in days.items() if d.weekday() < 5 and d not in rest]
    other = [len(v) for d, v in days.items() if d.weekday() >= 5 or d in rest]
    return (
        month.strftime("%Y-%m"),
        len({u for u, d in users if d < end}),
        len(now),
        len(now - new),
        sum(trading) // len(trading) if trading else None,
        sum(other) // len(other) if other else None,
        len(now & prior) / len(prior) if prior else None,
        len(now & new_before) / len(new_before) if new_before else None,
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force_with_one_busy_user(spark, seed):
    rnd = random.Random(seed)
    first = date(2023, 11, 1)
    ids = [fx.BASE + n for n in range(60)]
    records = [
        (ids[0] if rnd.random() < 0.4 else rnd.choice(ids), first + timedelta(rnd.randrange(160)))
        for _ in range(600)
    ]
    users = [(u, first + timedelta(rnd.randrange(-60, 160))) for u in ids for _ in range(1 + u % 2)]
    rest = {first + timedelta(rnd.randrange(160)) for _ in range(25)}

    raw = fx.records(spark, [(u, f"{d} 10:00:00", "1.1.1.1") for u, d in records])
    signups = fx.users(spark, [(u, fx.millis(str(d))) for u, d in users])
    rest_df = fx.rest_days(spark, [("CN", str(d)) for d in rest])
    stat_all = {
        r.month_time: tuple(r)
        for r in month_stat.month_user_stat_all(
            tables.visits_from_records(raw, fx.MARCH), signups, rest_df, fx.MARCH
        ).collect()
    }
    months = sorted({d.replace(day=1) for _, d in records})
    assert sorted(stat_all) == [m.strftime("%Y-%m") for m in months]
    totals = []
    for month in months:
        want = _brute(records, users, rest, month)
        assert stat_all[want[0]] == want
        params = MonthParams.for_month(want[0])
        visits = tables.visits_from_records(raw, params, params.previous, params.following)
        one = month_stat.month_user_stat(visits, signups, rest_df, params)
        assert tuple(one.first()) == want
        totals.append(want[1])
        assert want[3] <= want[2]
        assert all(r is None or 0 <= r <= 1 for r in want[-2:])
    assert totals == sorted(totals)


def test_trading_and_other_days_split_all_days(spark):
    from monthlens.operators.daily import daily_users, other_days, trading_days

    visits, _, rest_table = _inputs(spark)
    days = daily_users(visits)
    rest = tables.rest_dates(rest_table, fx.MARCH)
    parts = trading_days(days, rest).select("day").union(other_days(days, rest).select("day"))
    assert sorted(r.day for r in parts.collect()) == sorted(r.day for r in days.collect())


@pytest.mark.parametrize("kind", ["string", "timestamp_ntz", "timestamp", "date"])
def test_months_of_texts_and_typed_columns(spark, kind):
    from monthlens.functions.dates import in_days, month_of

    texts = ["2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-02-29 12:00:00"]
    texts += ["2024-03-31 23:59:59", "2024-04-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(
        "t as text", f"cast(t as {kind}) as t"
    )
    start, end = date(2024, 1, 1), date(2024, 4, 1)
    kept = df.where(in_days(df, "t", start, end))
    rows = kept.select("text", month_of(df, "t").alias("month")).collect()
    assert [r.text for r in rows] == texts[1:4]
    for r in rows:
        assert r.month == date.fromisoformat(r.text[:8] + "01")


ODD_DAYS = ["2024-03-00 10:00:00", "2024-03", "2024-13-05", "2024-03-xx", "2024-02-29", "2024-04-00"]


def test_one_month_rule_for_odd_texts(spark):
    """The first seven characters are the month, if they are one, on every path."""
    records = fx.records(spark, [(fx.BASE + i, t, "10.0.0.1") for i, t in enumerate(ODD_DAYS)])
    _, signups, rest = _inputs(spark)
    p = fx.MARCH
    bounded = tables.visits_from_records(records, p, p.previous, p.following)
    assert _row(month_stat.month_user_stat(bounded, signups, rest, p))["mau"] == 3
    whole = tables.visits_from_records(records, p)
    rows = month_stat.month_user_stat_all(whole, signups, rest, p).collect()
    assert {r.month_time: r.mau for r in rows} == {"2024-02": 1, "2024-03": 3, "2024-04": 1}
    etl_rows = etl.login_etl(records, fx.blocks(spark, [("aa", 0, 2**32 - 1)]), p).collect()
    assert {(r.uid - fx.BASE, r.month_time) for r in etl_rows} == {
        (i, "2024-03") for i in (0, 1, 3)
    }


@pytest.mark.parametrize("odd", [2**63 - 1, -(2**63), None, 2434028380862])
def test_extreme_registrations(spark, odd):
    users = [*fx.USERS, (fx.BASE + 8, odd), (fx.BASE + 1, odd)]
    visits, signups, rest = _inputs(spark, users=users)
    one = _row(month_stat.month_user_stat(visits, signups, rest, fx.MARCH))
    every = tables.visits_from_records(fx.records(spark), fx.MARCH)
    rows = month_stat.month_user_stat_all(every, signups, rest, fx.MARCH).collect()
    assert next(r.asDict() for r in rows if r.month_time == "2024-03") == one
    assert one["register_number"] == (6 if odd is not None and odd < 0 else 5)


def test_odd_partition_of_a_snapshot(spark):
    visits, signups, rest = _inputs(spark)
    months = F.date_format(month_of_millis("created_at", "UTC"), "yyyy-MM")
    named = signups.withColumn(
        "ds", F.when(F.col("id") == fx.BASE + 6, "latest").otherwise(months)
    )
    one = _row(month_stat.month_user_stat(visits, named, rest, fx.MARCH))
    every = tables.visits_from_records(fx.records(spark), fx.MARCH)
    rows = month_stat.month_user_stat_all(every, named, rest, fx.MARCH).collect()
    assert next(r.asDict() for r in rows if r.month_time == "2024-03") == one == fx.STAT


def test_instants_count_in_the_zone_of_the_run(spark):
    """The last hours of February in UTC are March in Shanghai, for logins and registrations."""
    p = MonthParams.for_month("2024-03", time_zone="Asia/Shanghai")
    at = "2024-02-29 20:00:00"
    instants = fx.records(spark, [(fx.BASE + 1, at, "10.0.0.1")]).withColumn(
        "recordtime", F.col("recordtime").cast("timestamp")
    )
    users = fx.users(spark, [(fx.BASE + 1, fx.millis(at.replace(" ", "T")))])
    visits = tables.visits_from_records(instants, p, p.previous, p.following)
    row = _row(month_stat.month_user_stat(visits, users, fx.rest_days(spark), p))
    assert (row["mau"], row["mau_exclude_register"], row["register_number"]) == (1, 0, 1)
    days = etl.login_etl(instants, fx.blocks(spark, [("aa", 0, 2**32 - 1)]), p).collect()
    assert [(r.month_time, r.day_time) for r in days] == [("2024-03", "2024-03-01")]
