"""Day and month expressions over columns stored as text, date or timestamp.

Filters compare the stored column itself with a literal of its own type, so that
they reach the Parquet reader. Parsing to a date comes after the filter.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from monthlens.params import month_start


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def in_zone(df: DataFrame, name: str, time_zone: str) -> DataFrame:
    """``df`` with a column of instants as the local times of a zone; other types stay."""
    if not isinstance(df.schema[name].dataType, T.TimestampType):
        return df
    local = f"convert_timezone(current_timezone(), '{time_zone}', cast({name} as timestamp_ntz))"
    return df.withColumn(name, F.expr(local))


def _bound(df: DataFrame, name: str, day: date) -> Column:
    """``day`` as a bound. A month begins with the first text that starts with it."""
    if not is_text(df, name):
        return F.lit(day)
    return F.lit(day.strftime("%Y-%m") if day.day == 1 else day.isoformat())


def in_days(df: DataFrame, name: str, start: date | None, end: date | None) -> Column:
    """``start <= column < end``; a bound of None is open."""
    condition = F.col(name).isNotNull()
    if start is not None:
        condition &= F.col(name) >= _bound(df, name, start)
    if end is not None:
        condition &= F.col(name) < _bound(df, name, end)
    return condition


def after_month(month: date) -> str:
    """The first text after all that begin with the month."""
    label = month.strftime("%Y-%m")
    return label[:-1] + chr(ord(label[-1]) + 1)


def up_to_month(df: DataFrame, name: str, last: date) -> Column:
    """The column's month is not after the month that starts on ``last``.

    For text this is ``substr(column, 1, 7) <= 'YYYY-MM'`` written as a plain
    comparison: the bound is the first text after all that begin with the month.
    """
    if is_text(df, name):
        return F.col(name) < F.lit(after_month(last))
    return F.col(name) < F.lit(month_start(last, 1))


def day_of(df: DataFrame, name: str) -> Column:
    """The calendar day; NULL where the first ten characters of a text are no date."""
    if is_text(df, name):
        day = f"substring({name}, 1, 10)"
        return F.expr(f"if(length({name}) >= 10, try_cast({day} as date), null)")
    return F.expr(f"cast({name} as date)")


def month_of(df: DataFrame, name: str) -> Column:
    """First day of the month. Of a text the first seven characters count, if they are a month."""
    if is_text(df, name):
        return F.expr(f"try_cast(concat(substring({name}, 1, 7), '-01') as date)")
    return F.expr(f"trunc(cast({name} as date), 'MM')")


#: Epoch milliseconds of the year 1; earlier ones cannot be turned into a date.
FIRST_MILLIS = -62135596800000


def month_of_millis(name: str, time_zone: str) -> Column:
    """First day of the month in ``time_zone``, whatever the session's zone is.

    Times before the year 1 count in its first month, so that none is an error.
    """
    millis = f"if({name} < {FIRST_MILLIS}L, {FIRST_MILLIS}L, {name})"
    time = f"timestampadd(millisecond, {millis}, timestamp_ntz'1970-01-01 00:00:00')"
    if time_zone != "UTC":
        time = f"convert_timezone('UTC', '{time_zone}', {time})"
    return F.expr(f"trunc(cast({time} as date), 'MM')")


def second_text(name: str) -> Column:
    """The column as ``YYYY-MM-DD hh:mm:ss`` text, cut to whole seconds."""
    return F.substring(F.col(name).cast("string"), 1, 19)


def month_text(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")
