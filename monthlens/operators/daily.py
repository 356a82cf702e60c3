"""Daily active users and their means over trading and other days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def daily_users(visits: DataFrame) -> DataFrame:
    """Distinct users per day."""
    known = visits.where(F.col("day").isNotNull())
    return known.groupBy("day").agg(F.count_distinct("uid").alias("dau"))


def is_weekday(day: Column) -> Column:
    return F.dayofweek(day).between(2, 6)


def trading_days(days: DataFrame, rest: DataFrame) -> DataFrame:
    """Monday to Friday, less the rest dates. ``rest`` has one row per calendar day at most."""
    return days.where(is_weekday(F.col("day"))).join(F.broadcast(rest), "day", "left_anti")


def other_days(days: DataFrame, rest: DataFrame) -> DataFrame:
    """Rest dates, Saturdays and Sundays."""
    marked = with_rest_date(days, rest)
    return marked.where(F.col("rest_date").isNotNull() | ~is_weekday(F.col("day")))


def with_rest_date(days: DataFrame, rest: DataFrame) -> DataFrame:
    """``rest_date`` is the day itself on a rest date and NULL on others."""
    dates = F.broadcast(rest.select(F.col("day").alias("rest_date")))
    return days.join(dates, F.col("day") == F.col("rest_date"), "left")


def whole_mean(value: Column) -> Column:
    """Mean cut to a whole number; NULL over no rows."""
    return F.avg(value).cast("bigint")
