"""Input tables in the form the pipelines use.

Frames passed around the package:

* visits   -- ``uid``, ``month`` (first day), ``day`` (NULL where the text is no date)
* signups  -- ``id``, ``created_at`` in epoch milliseconds, perhaps the partition ``ds``
* installs -- ``source`` ('device' or 'client'), ``user_id``, ``type``, ``version``,
  ``created_at``, ``channel``
* blocks   -- ``cc``, ``lo``, ``hi``: address ranges, both ends included, not overlapping
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from monthlens.functions.dates import day_of, in_days, in_zone, month_of, up_to_month
from monthlens.params import MonthParams, month_start

DEVICE = "device"
CLIENT = "client"
ANDROID = 1
IPHONE = 2


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A Parquet table. With a schema, a partition value such as 2024-01 stays text."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_partitioned(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """A table whose columns are not declared, with its partition value kept as text."""
    found = spark.read.parquet(path).schema
    schema = T.StructType([field for field in found if field.name != partition])
    return read_table(spark, path, schema.add(partition, T.StringType()))


def valid_ids(df: DataFrame, name: str, params: MonthParams) -> DataFrame:
    return df.where(F.col(name).between(params.min_uid, params.max_uid))


def visits_from_records(
    records: DataFrame,
    params: MonthParams,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Visits straight from raw logins (``userid``, ``recordtime``)."""
    records = in_zone(records, "recordtime", params.time_zone)
    kept = valid_ids(records, "userid", params).where(in_days(records, "recordtime", start, end))
    return kept.select(
        F.col("userid").alias("uid"),
        month_of(records, "recordtime").alias("month"),
        day_of(records, "recordtime").alias("day"),
    )


def visits_from_logins(
    logins: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Visits from the login table (``uid``, ``day_time``, maybe ``month_time``).

    ``month_time`` is the month of ``day_time``; its own range lets Spark skip
    whole partitions where the table is partitioned by it.
    """
    kept = logins.where(in_days(logins, "day_time", start, end))
    if "month_time" in logins.columns and start is not None and end is not None:
        last = month_start(end) if end.day > 1 else month_start(end, -1)
        kept = kept.where(
            F.col("month_time").between(start.strftime("%Y-%m"), last.strftime("%Y-%m"))
        )
    return kept.select(
        "uid",
        month_of(logins, "day_time").alias("month"),
        day_of(logins, "day_time").alias("day"),
    )


def malformed_count(df: DataFrame, name: str) -> Column:
    """How many rows hold a day text that is no date; such rows count in no daily figure."""
    lost = F.col(name).isNotNull() & day_of(df, name).isNull()
    return F.count_if(lost).alias("malformed")


def malformed_days(df: DataFrame, name: str) -> DataFrame:
    return df.agg(malformed_count(df, name))


def rest_dates(
    rest_days: DataFrame,
    params: MonthParams,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Distinct rest dates of the run's exchange area: at most one row per calendar day."""
    return (
        rest_days.where(F.col("exchange_area") == params.exchange_area)
        .where(in_days(rest_days, "rest_date", start, end))
        .select(day_of(rest_days, "rest_date").alias("day"))
        .where(F.col("day").isNotNull())
        .distinct()
    )


def installs(device: DataFrame, client: DataFrame) -> DataFrame:
    """Both install tables as one frame; the device table carries no channel."""
    columns = ["user_id", "type", "version", "created_at"]
    return device.select(
        F.lit(DEVICE).alias("source"), *columns, F.lit(None).cast("string").alias("channel")
    ).unionByName(client.select(F.lit(CLIENT).alias("source"), *columns, "channel"))


def due_later(installs: DataFrame, params: MonthParams) -> DataFrame:
    """Installs of months after the reported one, as they are."""
    times = in_zone(installs.withColumn("_at", F.col("created_at")), "_at", params.time_zone)
    later = F.col("_at").isNotNull() & ~up_to_month(times, "_at", params.start)
    return times.where(later).drop("_at")
