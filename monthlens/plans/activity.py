"""Each figure of the monthly statistic on its own, one row per call.

``monthlens.plans.month_stat`` computes all of them together in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from monthlens.functions.dates import month_text
from monthlens.operators import marks as m
from monthlens.operators.daily import daily_users, other_days, trading_days, whole_mean
from monthlens.params import MonthParams
from monthlens.sources.tables import rest_dates


def _labelled(df: DataFrame, params: MonthParams, *columns: Column) -> DataFrame:
    return df.agg(*columns).select(F.lit(params.label).alias("month_time"), "*")


def _in_month(visits: DataFrame, params: MonthParams) -> DataFrame:
    return visits.where(F.col("month") == F.lit(params.start))


def _rest(rest_days: DataFrame, params: MonthParams) -> DataFrame:
    return rest_dates(rest_days, params, params.start, params.following)


def register_number(signups: DataFrame, params: MonthParams) -> DataFrame:
    """Users registered up to the end of the month."""
    known = signups.where(m.registered_by_month_end(signups, params))
    return _labelled(known, params, F.count_distinct("id").alias("register_number"))


def register_number_month(signups: DataFrame, params: MonthParams) -> DataFrame:
    """Users registered within the month."""
    inside = F.col("created_at") >= params.millis(params.start)
    inside &= F.col("created_at") < params.millis(params.following)
    return _labelled(
        signups.where(inside), params, F.count_distinct("id").alias("register_number")
    )


def signups_without_id(signups: DataFrame, params: MonthParams) -> DataFrame:
    """How many of the month's registrations have no id."""
    inside = m.created_in(params, params.start, params.following)
    return signups.where(inside).agg(F.count_if(F.col("id").isNull()).alias("lost"))


def mau(visits: DataFrame, params: MonthParams) -> DataFrame:
    """Users active in the month."""
    return _labelled(_in_month(visits, params), params, F.count_distinct("uid").alias("mau"))


def mau_exclude_register(
    visits: DataFrame, signups: DataFrame, params: MonthParams
) -> DataFrame:
    """Users active in the month and not registered in it."""
    users = m.merge_marks(
        [
            m.visit_marks(_in_month(visits, params), params),
            m.recent_signup_marks(signups, params),
        ],
        ["uid"],
    )
    return _labelled(users, params, m.count_not_signed_up("mau_exclude_register"))


def mau_exclude_register_by_month(
    visits: DataFrame, signups: DataFrame, time_zone: str = "UTC"
) -> DataFrame:
    """``mau_exclude_register`` of every month that has a visit."""
    users = m.merge_marks(
        [m.visit_marks_all(visits), m.signup_marks_all(signups, time_zone)], ["month", "uid"]
    )
    counted = users.groupBy("month").agg(
        m.count_users("mau", m.ACTIVE),
        m.count_not_signed_up("mau_exclude_register"),
    )
    return counted.where(F.col("mau") > 0).select(
        month_text(F.col("month")).alias("month_time"), "mau_exclude_register"
    )


def dau_by_day(visits: DataFrame, params: MonthParams) -> DataFrame:
    """Users active on each day of the month."""
    days = daily_users(_in_month(visits, params))
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("day_time"), "dau")


def exchange_dau(visits: DataFrame, rest_days: DataFrame, params: MonthParams) -> DataFrame:
    """Mean daily users over trading days."""
    days = trading_days(daily_users(_in_month(visits, params)), _rest(rest_days, params))
    return _labelled(days, params, whole_mean(F.col("dau")).alias("exchange_dau"))


def non_exchange_dau(visits: DataFrame, rest_days: DataFrame, params: MonthParams) -> DataFrame:
    """Mean daily users over rest days and weekends."""
    days = other_days(daily_users(_in_month(visits, params)), _rest(rest_days, params))
    return _labelled(days, params, whole_mean(F.col("dau")).alias("non_exchange_dau"))


def keep_ratio(visits: DataFrame, params: MonthParams) -> DataFrame:
    """Share of the previous month's users who are active in the month."""
    users = m.merge_marks([m.visit_marks(visits, params)], ["uid"])
    counted = _labelled(
        users,
        params,
        m.count_users("numerator", m.ACTIVE_BEFORE | m.ACTIVE),
        m.count_users("denominator", m.ACTIVE_BEFORE),
    )
    return counted.withColumn("keep_ratio", F.try_divide("numerator", "denominator"))


def new_user_keep_ratio(
    visits: DataFrame, signups: DataFrame, params: MonthParams
) -> DataFrame:
    """Share of the users registered in the previous month who are active in the month."""
    users = m.merge_marks(
        [
            m.visit_marks(_in_month(visits, params), params),
            m.recent_signup_marks(signups, params),
        ],
        ["uid"],
    )
    counted = _labelled(
        users,
        params,
        m.count_users("active_again", m.SIGNED_UP_BEFORE | m.ACTIVE),
        m.count_users("register_number", m.SIGNED_UP_BEFORE),
    )
    return counted.withColumn(
        "new_user_keep_ratio", F.try_divide("active_again", "register_number")
    )
