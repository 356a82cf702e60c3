"""Exact sets of users that are stored, merged and intersected without the rows they came from.

A set is kept as bitmaps: 32,768 neighbouring ids share a bucket, and a bucket with any user is a
row with 4 KB of bits. Two sets are united by or-ing their bitmaps and intersected by and-ing them,
bucket by bucket, so figures over months cost as much as the sets are wide and not as many rows as
were read. Counts are exact, and a user counted in several partitions counts once.

Rows of a table of sets:

* ``kind``   -- what the users did, see below
* ``label``  -- the month ``YYYY-MM`` or day ``YYYY-MM-DD`` when they did it
* ``bucket`` -- which ids; NULL for the row of rows without an id
* ``bits``   -- the users, one bit each
* ``lost``   -- how many rows had no id

and perhaps ``ds``, the partition they were read from. Rows without an id are in no set; they are
counted because ``NOT IN`` asks for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from monthlens.functions.dates import month_of_millis, month_text
from monthlens.operators.marks import CREATED_AT_BOUND

ACTIVE = "active"  # by month, and by day where the day is known
SIGNED_UP = "signed_up"  # by month of the registration, if that is believed
REGISTERED = "registered"  # by month in which the snapshot has the registration

_KEYS = ["kind", "label"]


def sets_of(rows: DataFrame, user: str = "uid") -> DataFrame:
    """The sets of ``kind, label, user`` rows."""
    placed = rows.select(
        *_KEYS,
        F.bitmap_bucket_number(F.col(user)).alias("bucket"),
        F.bitmap_bit_position(F.col(user)).alias("bit"),
    )
    return placed.groupBy(*_KEYS, "bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits"),
        F.count_if(F.col("bit").isNull()).alias("lost"),
    )


def visit_sets(visits: DataFrame) -> DataFrame:
    """Who was active on each day and in each month of the visits.

    The sets of the days are made from rows, those of the months from the days' bitmaps.
    """
    dated = visits.where("month is not null").select(
        "uid",
        F.lit(ACTIVE).alias("kind"),
        month_text(F.col("month")).alias("month"),
        F.date_format("day", "yyyy-MM-dd").alias("label"),
    )
    placed = dated.select(
        "kind",
        "month",
        "label",
        F.bitmap_bucket_number(F.col("uid")).alias("bucket"),
        F.bitmap_bit_position(F.col("uid")).alias("bit"),
    )
    by_day = placed.groupBy("kind", "month", "label", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits"),
        F.count_if(F.col("bit").isNull()).alias("lost"),
    )
    both = by_day.select(
        "kind", "bucket", "bits", "lost", F.explode(F.array("label", "month")).alias("label")
    )
    return united(both.where("label is not null"))


def signup_sets(signups: DataFrame, time_zone: str) -> DataFrame:
    """Who registered in each month, and who is known in each month's snapshot.

    The snapshot's month is its partition ``ds``, or the month of the registration without one.
    """
    month = month_text(month_of_millis("created_at", time_zone))
    believed = F.when(F.col("created_at") < CREATED_AT_BOUND, month)
    known = F.substring("ds", 1, 7) if "ds" in signups.columns else month
    labels = F.array(
        F.struct(F.lit(SIGNED_UP).alias("kind"), believed.alias("label")),
        F.struct(F.lit(REGISTERED).alias("kind"), known.alias("label")),
    )
    rows = signups.select(F.col("id").alias("uid"), F.inline(labels))
    return sets_of(rows.where("label is not null"))


def united(sets: DataFrame, *keys: str) -> DataFrame:
    """One set per key, of the users in any of the sets that have it."""
    keys = keys or tuple(_KEYS)
    return sets.groupBy(*keys, "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.sum("lost").alias("lost")
    )


def named_sets(sets: DataFrame, names: dict[str, Column]) -> DataFrame:
    """``name, bucket, bits, lost``: per name, the union of the sets that meet its condition.

    Sets that meet none are left out before the shuffle.
    """
    matching = F.array_compact(
        F.array(*(F.when(condition, F.lit(name)) for name, condition in names.items()))
    )
    asked = sets.select("bucket", "bits", "lost", F.explode(matching).alias("name"))
    return united(asked, "name")


def with_intersections(named: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """``named`` and, under the name of each pair, the users in both of its sets.

    A bucket that one of the two sets lacks has nobody in both.
    """
    names = [
        F.when(F.col("name").isin(*pair), F.lit(name)) for name, pair in pairs.items()
    ]
    rows = named.select(
        "bucket",
        "bits",
        "lost",
        "name",
        F.explode(F.concat(F.array("name"), F.array_compact(F.array(*names)))).alias("result"),
    )
    both = rows.groupBy("bucket", "result").agg(
        F.bitmap_and_agg("bits").alias("bits"),
        F.sum("lost").alias("lost"),
        F.count("*").alias("sets"),
    )
    complete = (F.col("sets") == 2) | ~F.col("result").isin(*pairs)
    return both.where(complete).select(F.col("result").alias("name"), "bucket", "bits", "lost")


def users_in(name: str) -> Column:
    """How many users the set ``name`` has; 0 if it has no rows."""
    size = F.when(F.col("name") == name, F.bitmap_count(F.col("bits")))
    return F.coalesce(F.sum(size), F.lit(0)).alias(name)


def rows_without_id(name: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("name") == name, F.col("lost"))), F.lit(0))
