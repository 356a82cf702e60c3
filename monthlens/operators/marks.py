"""One bit mask per user: what the user did in a month, in the month before, and when.

Every figure of the monthly statistic asks whether a user did this or that, and
counts the users. So each input row becomes a mask, all masks of a user are or-ed
together in one hash aggregate, and the figures are conditional counts over the
result. Rows of one user collapse before the shuffle, however many there are.

Bit 0 is a visit in the month, bits 1 to 31 a visit on that day of the month.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from monthlens.functions.dates import after_month, month_of_millis
from monthlens.params import MonthParams

ACTIVE = 1
ACTIVE_BEFORE = 1 << 32
SIGNED_UP = 1 << 33
SIGNED_UP_BEFORE = 1 << 34
REGISTERED = 1 << 35  # by the end of the month
FIRST_SIGN_UP = 1 << 36  # the month of the user's earliest registration

# Fixed value: registrations at or after this epoch millisecond are not believed.
CREATED_AT_BOUND = 2434028380862

_VISIT_MASK = f"{ACTIVE}L | coalesce(shiftleft(1L, dayofmonth(day)), 0L)"


def visit_marks(visits: DataFrame, params: MonthParams) -> DataFrame:
    """Marks of the visits in the reported month and the one before it."""
    return visits.selectExpr(
        "uid",
        f"case month when date'{params.start}' then {_VISIT_MASK} "
        f"when date'{params.previous}' then {ACTIVE_BEFORE}L end as mark",
    )


def registered_by_month_end(signups: DataFrame, params: MonthParams) -> str:
    """In the snapshot up to the month's partition, or created before the month ended.

    Both are plain comparisons, so that whole partitions or row groups are left out.
    """
    if "ds" in signups.columns:
        return f"ds < '{after_month(params.start)}'"
    return f"created_at < {params.millis(params.following)}"


def created_in(params: MonthParams, start, end) -> str:
    first, last = params.millis(start), min(params.millis(end), CREATED_AT_BOUND)
    return f"(created_at >= {first} and created_at < {last})"


def signup_marks(
    signups: DataFrame, params: MonthParams, one_read: bool = False
) -> list[DataFrame]:
    """Marks of all registrations up to the end of the reported month.

    A snapshot with partitions is read twice, as each read is pruned by its own column: the
    partitions up to the month, ids only, and the row groups of the two recent months. With
    ``one_read`` it is one frame.
    """
    if "ds" in signups.columns and not one_read:
        recent = recent_signup_marks(signups, params)
        known = signups.where(registered_by_month_end(signups, params))
        return [known.selectExpr("id as uid", f"{REGISTERED}L as mark"), recent]
    tests = {
        REGISTERED: registered_by_month_end(signups, params),
        SIGNED_UP: created_in(params, params.start, params.following),
        SIGNED_UP_BEFORE: created_in(params, params.previous, params.start),
    }
    mask = " | ".join(f"if({test}, {bit}L, 0L)" for bit, test in tests.items())
    return [
        signups.where(" or ".join(tests.values())).selectExpr("id as uid", f"{mask} as mark")
    ]


def recent_signup_marks(signups: DataFrame, params: MonthParams) -> DataFrame:
    """Marks of the registrations in the reported month and the one before it."""
    return signups.where(created_in(params, params.previous, params.following)).selectExpr(
        "id as uid",
        f"if(created_at >= {params.millis(params.start)}, {SIGNED_UP}L, {SIGNED_UP_BEFORE}L)"
        " as mark",
    )


def visit_marks_all(visits: DataFrame) -> DataFrame:
    """Marks of the visits of every month."""
    return visits.where("month is not null").selectExpr("uid", "month", f"{_VISIT_MASK} as mark")


def signup_marks_all(signups: DataFrame, time_zone: str) -> DataFrame:
    """Marks of the believed registrations of every month."""
    return signups.where(f"created_at < {CREATED_AT_BOUND}").select(
        F.col("id").alias("uid"),
        month_of_millis("created_at", time_zone).alias("month"),
        F.expr(f"{SIGNED_UP}L as mark"),
    )


def all_signup_marks(signups: DataFrame, time_zone: str) -> DataFrame:
    """Marks of every month with a believed registration, and of each user's earliest one.

    One aggregate per id gives both; an id has no more months than the calendar. The earliest
    one is the first partition ``ds`` that is a month, if there are partitions.
    """
    believed = f"if(created_at < {CREATED_AT_BOUND}, created_at, null)"
    dated = signups.select("*", month_of_millis(believed, time_zone).alias("month"))
    first = "month"
    if "ds" in signups.columns:
        first = "try_cast(concat(substring(ds, 1, 7), '-01') as date)"
    per_id = dated.groupBy(F.col("id").alias("uid")).agg(
        F.expr(f"min({first}) as first"), F.expr("collect_set(month) as months")
    )
    return per_id.selectExpr(
        "uid",
        "inline(concat("
        f"transform(months, m -> struct(m as month, {SIGNED_UP}L as mark)), "
        f"if(first is null, array(), array(struct(first as month, {FIRST_SIGN_UP}L as mark)))))",
    )


def merge_marks(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """All marks of a key or-ed together: one shuffle, one row per key and task.

    ``known`` holds the marks again, but none where the user id is missing: such rows
    count in no figure.
    """
    merged = reduce(DataFrame.unionByName, frames).groupBy(*keys).agg(
        F.expr("bit_or(mark) as marks")
    )
    return merged.selectExpr(*keys, "marks", "if(uid is not null, marks, 0L) as known")


def merge_marks_in_place(visits: DataFrame, signups: DataFrame) -> DataFrame:
    """``merge_marks`` by user, for marks from two tables that are stored by user.

    Each side is or-ed on its own and the results, one row per user, are joined. With equal
    buckets neither step has a shuffle, which a union would need.
    """
    came = visits.groupBy("uid").agg(F.expr("bit_or(mark) as came"))
    joined = signups.groupBy("uid").agg(F.expr("bit_or(mark) as joined"))
    merged = came.join(joined, "uid", "full").selectExpr(
        "uid", "coalesce(came, 0L) | coalesce(joined, 0L) as marks"
    )
    return merged.selectExpr("uid", "marks", "if(uid is not null, marks, 0L) as known")


def mark_month_before(users: DataFrame) -> DataFrame:
    """Marks per month and user, with what the user did in the month before added.

    Each row is repeated in the following month, with its bits moved to the 'before' bits.
    """
    moved = (
        f"if(marks & {ACTIVE}L != 0, {ACTIVE_BEFORE}L, 0L)"
        f" | if(marks & {SIGNED_UP}L != 0, {SIGNED_UP_BEFORE}L, 0L)"
    )
    both = users.selectExpr(
        "uid",
        "inline(array(struct(month, marks as mark),"
        f" struct(add_months(month, 1) as month, {moved} as mark)))",
    )
    return merge_marks([both], ["month", "uid"])


def count_users(name: str, bits: int, without: int = 0) -> Column:
    """Users with all of ``bits`` and none of ``without``."""
    return F.expr(f"count_if(known & {bits | without}L = {bits}L) as {name}")


def count_visitors_by_day(name: str) -> Column:
    """Users per day of the month, as an array of 31; NULL over no rows."""
    days = ", ".join(f"sum(shiftright(known, {day}) & 1L)" for day in range(1, 32))
    return F.expr(f"array({days}) as {name}")


def count_not_signed_up(name: str) -> Column:
    """Active users whose id is not among the month's registrations, as ``NOT IN`` counts them.

    Under SQL's rules one registration without an id leaves nobody to count.
    """
    return F.expr(
        f"if(count_if(uid is null and marks & {SIGNED_UP}L != 0) > 0, 0L,"
        f" count_if(known & {ACTIVE | SIGNED_UP}L = {ACTIVE}L)) as {name}"
    )
