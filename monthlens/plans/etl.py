"""The two tables the statistic is built from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from monthlens.functions.dates import in_days, in_zone, is_text
from monthlens.functions.ip import with_ip_number
from monthlens.operators.iplookup import with_country
from monthlens.params import MonthParams
from monthlens.sources.tables import malformed_count, valid_ids


def user_snapshot_month(users: DataFrame, params: MonthParams) -> DataFrame:
    """All columns of the users registered in the month."""
    created = F.col("created_at")
    return valid_ids(users, "id", params).where(
        (created >= params.millis(params.start)) & (created < params.millis(params.following))
    )


def ip_country(records: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every raw login with its address as a number and the country that holds it."""
    numbered = with_ip_number(records.select("userid", "loginip"), "loginip", "ip_num")
    return with_country(numbered, blocks, nested=True)


def in_month(records: DataFrame, params: MonthParams) -> DataFrame:
    """Raw logins of real users in the month; of a text the first seven characters are the month."""
    records = in_zone(records, "recordtime", params.time_zone)
    inside = in_days(records, "recordtime", params.start, params.following)
    if is_text(records, "recordtime"):
        inside &= F.substring("recordtime", 1, 7) == params.label
    return valid_ids(records, "userid", params).where(inside)


def login_etl(
    records: DataFrame,
    blocks: DataFrame,
    params: MonthParams,
    observation: Observation | None = None,
) -> DataFrame:
    """Distinct user, day and country of the month's raw logins.

    ``month_time`` and ``day_time`` are the first 7 and 10 characters of the login time. An
    ``observation`` receives ``malformed`` when the result is written: the raw logins whose day is
    no date. They are counted in the same pass.
    """
    month = in_month(records, params)
    text = is_text(records, "recordtime")
    day = "substring(recordtime, 1, 10)" if text else "date(recordtime)"
    daily = month.selectExpr("userid as uid", f"{day} as day", "loginip")
    located = with_country(with_ip_number(daily, "loginip", "ip_num"), blocks, nested=True)
    if observation is not None:
        # every login is one row here still
        located = located.observe(observation, malformed_count(located, "day"))
    # The texts are made after the shuffle, which then carries only what tells rows apart.
    return located.select("uid", "day", "cc").distinct().selectExpr(
        "uid",
        "substring(cast(day as string), 1, 7) as month_time",
        "cast(day as string) as day_time",
        "cc as city",
    )
