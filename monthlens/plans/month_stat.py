"""The monthly user statistic: all figures from one scan per input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from monthlens.operators import marks as m
from monthlens.operators.daily import is_weekday, whole_mean, with_rest_date
from monthlens.params import MonthParams
from monthlens.sources.tables import rest_dates

FIGURES = [
    "month_time",
    "register_number",
    "mau",
    "mau_exclude_register",
    "exchange_dau",
    "non_exchange_dau",
    "keep_ratio",
    "new_user_keep_ratio",
]
_TOTALS = [
    "register_number",
    "mau",
    "mau_exclude_register",
    "kept",
    "active_before",
    "kept_new",
    "new_before",
]


def _counts(registered: int) -> list[Column]:
    return [
        m.count_users("register_number", registered),
        m.count_users("mau", m.ACTIVE),
        m.count_not_signed_up("mau_exclude_register"),
        m.count_users("kept", m.ACTIVE_BEFORE | m.ACTIVE),
        m.count_users("active_before", m.ACTIVE_BEFORE),
        m.count_users("kept_new", m.SIGNED_UP_BEFORE | m.ACTIVE),
        m.count_users("new_before", m.SIGNED_UP_BEFORE),
        m.count_visitors_by_day("dau"),
    ]


def days_of(counted: DataFrame) -> DataFrame:
    """31 rows per month, one for each possible day; ``dau`` is NULL where nobody came."""
    rows = counted.selectExpr("month", *_TOTALS, "posexplode(dau) as (offset, users)")
    return rows.selectExpr(
        "month", *_TOTALS, "date_add(month, offset) as day", "nullif(users, 0) as dau"
    )


def means() -> list[Column]:
    """The day means over days that had a visit, and the totals carried through."""
    trades = is_weekday(F.col("day")) & F.col("rest_date").isNull()
    return [F.expr(f"max({name}) as {name}") for name in _TOTALS] + [
        whole_mean(F.when(trades, F.col("dau"))).alias("exchange_dau"),
        whole_mean(F.when(~trades, F.col("dau"))).alias("non_exchange_dau"),
    ]


def figures(df: DataFrame, month_time: str) -> DataFrame:
    return df.selectExpr(
        f"{month_time} as month_time",
        *FIGURES[1:-2],
        "try_divide(kept, active_before) as keep_ratio",
        "try_divide(kept_new, new_before) as new_user_keep_ratio",
    )


def month_user_stat(
    visits: DataFrame,
    signups: DataFrame,
    rest_days: DataFrame,
    params: MonthParams,
    stored_by_user: bool = False,
) -> DataFrame:
    """The statistic of one month, always one row.

    ``visits`` must cover the reported month and the one before it. Inputs that are bucketed by
    user, in equal numbers, are brought together ``stored_by_user``, without a shuffle.
    """
    marks = [m.visit_marks(visits, params), *m.signup_marks(signups, params, stored_by_user)]
    users = m.merge_marks_in_place(*marks) if stored_by_user else m.merge_marks(marks, ["uid"])
    month = F.expr(f"date'{params.start}' as month")
    counted = users.agg(*_counts(m.REGISTERED), month)
    rest = rest_dates(rest_days, params, params.start, params.following)
    days = with_rest_date(days_of(counted), rest)
    return figures(days.agg(*means()), f"'{params.label}'")


def month_user_stat_all(
    visits: DataFrame, signups: DataFrame, rest_days: DataFrame, params: MonthParams
) -> DataFrame:
    """The statistic of every month that has a visit, in one pass over all history."""
    users = m.merge_marks(
        [
            m.visit_marks_all(visits),
            m.all_signup_marks(signups, params.time_zone),
        ],
        ["month", "uid"],
    )
    counted = m.mark_month_before(users).groupBy("month").agg(*_counts(m.FIRST_SIGN_UP))
    days = with_rest_date(days_of(counted), rest_dates(rest_days, params))
    by_month = days.groupBy("month").agg(*means())
    # One row per calendar month is left here, so one task can add them up.
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = by_month.withColumn("register_number", F.sum("register_number").over(so_far))
    return figures(summed.where(F.col("mau") > 0), "date_format(month, 'yyyy-MM')")


def active_user_stat(stat: DataFrame) -> DataFrame:
    """The statistic as reported, ratios to four places."""
    return stat.select(
        *FIGURES[:-2],
        F.round("keep_ratio", 4).alias("keep_ratio"),
        F.round("new_user_keep_ratio", 4).alias("new_user_keep_ratio"),
    )
