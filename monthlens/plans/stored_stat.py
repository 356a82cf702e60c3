"""The monthly figures from stored sets of users: no login or registration is read again.

Each month's logins and snapshot partition are turned into sets once (``operators.usersets``).
A report then reads two months of visit sets and the registration sets, whatever the number of
rows they stand for, and gives what ``plans.activity`` and ``plans.month_stat`` give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from monthlens.functions.dates import after_month
from monthlens.operators import usersets as u
from monthlens.operators.daily import with_rest_date
from monthlens.params import MonthParams
from monthlens.plans.month_stat import days_of, figures, means
from monthlens.sources.tables import rest_dates

_PAIRS = {
    "kept": ("mau", "active_before"),
    "kept_new": ("mau", "new_before"),
    "active_signed_up": ("mau", "signed_up"),
}


def _names(params: MonthParams) -> dict[str, Column]:
    """The sets of a month's figures, as conditions on stored sets."""
    kind, label = F.col("kind"), F.col("label")
    before = params.previous.strftime("%Y-%m")
    return {
        "register_number": (kind == u.REGISTERED) & (label < after_month(params.start)),
        "mau": (kind == u.ACTIVE) & (label == params.label),
        "active_before": (kind == u.ACTIVE) & (label == before),
        "signed_up": (kind == u.SIGNED_UP) & (label == params.label),
        "new_before": (kind == u.SIGNED_UP) & (label == before),
    }


def _named(sets: DataFrame, params: MonthParams, *names: str) -> DataFrame:
    known = _names(params)
    return u.named_sets(sets, {name: known[name] for name in names})


def _row(named: DataFrame, params: MonthParams, *columns: Column) -> DataFrame:
    return named.agg(*columns).select(F.lit(params.label).alias("month_time"), "*")


def register_number(sets: DataFrame, params: MonthParams) -> DataFrame:
    named = _named(sets, params, "register_number")
    return _row(named, params, u.users_in("register_number"))


def mau(sets: DataFrame, params: MonthParams) -> DataFrame:
    return _row(_named(sets, params, "mau"), params, u.users_in("mau"))


def _paired(sets: DataFrame, params: MonthParams, pair: str, *others: str) -> DataFrame:
    named = _named(sets, params, *_PAIRS[pair], *others)
    return u.with_intersections(named, {pair: _PAIRS[pair]})


def keep_ratio(sets: DataFrame, params: MonthParams) -> DataFrame:
    """Share of the previous month's users who are in the month's set as well."""
    named = _paired(sets, params, "kept")
    counted = _row(named, params, u.users_in("kept"), u.users_in("active_before"))
    return counted.selectExpr(
        "month_time",
        "kept as numerator",
        "active_before as denominator",
        "try_divide(kept, active_before) as keep_ratio",
    )


def new_user_keep_ratio(sets: DataFrame, params: MonthParams) -> DataFrame:
    """Share of the users registered in the previous month who are in the month's set."""
    named = _paired(sets, params, "kept_new")
    counted = _row(named, params, u.users_in("kept_new"), u.users_in("new_before"))
    return counted.selectExpr(
        "month_time",
        "kept_new as active_again",
        "new_before as register_number",
        "try_divide(kept_new, new_before) as new_user_keep_ratio",
    )


def _not_signed_up() -> Column:
    """By the rules of ``NOT IN``: nobody, if a registration of the month has no id."""
    left = u.users_in("mau") - u.users_in("active_signed_up")
    count = F.when(u.rows_without_id("signed_up") > 0, F.lit(0)).otherwise(left)
    return count.cast("bigint").alias("mau_exclude_register")


def mau_exclude_register(sets: DataFrame, params: MonthParams) -> DataFrame:
    return _row(_paired(sets, params, "active_signed_up"), params, _not_signed_up())


def month_user_stat(sets: DataFrame, rest_days: DataFrame, params: MonthParams) -> DataFrame:
    """The statistic of one month, always one row."""
    days = {
        f"day{n}": (F.col("kind") == u.ACTIVE) & (F.col("label") == f"{params.label}-{n:02d}")
        for n in range(1, 32)
    }
    named = u.with_intersections(u.named_sets(sets, _names(params) | days), _PAIRS)
    sizes = ["register_number", "mau", "kept", "active_before", "kept_new", "new_before"]
    counted = named.agg(
        *(u.users_in(name) for name in sizes),
        _not_signed_up(),
        F.array(*(u.users_in(name) for name in days)).alias("dau"),
    ).withColumn("month", F.lit(params.start))
    rest = rest_dates(rest_days, params, params.start, params.following)
    dated = with_rest_date(days_of(counted), rest)
    return figures(dated.agg(*means()), f"'{params.label}'")
