"""Newest install per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from monthlens.functions.dates import in_zone, second_text, up_to_month
from monthlens.params import MonthParams
from monthlens.sources.tables import ANDROID, DEVICE, IPHONE

_RECORD = ["download_time", "version", "channel"]


def usable_installs(installs: DataFrame, params: MonthParams) -> DataFrame:
    """Android and iPhone installs of real users up to the reported month.

    Times are cut to the second. Installs in the device table have the channel ''.
    """
    installs = in_zone(installs, "created_at", params.time_zone)
    labels = {ANDROID: params.android_label, IPHONE: params.iphone_label}
    named = [
        (F.col("type") == code) & ((F.lit(label) != "") | (F.col("version") != ""))
        for code, label in labels.items()
    ]
    return (
        installs.where(F.col("user_id") > 0)
        .where(F.col("type").isin(ANDROID, IPHONE) & F.col("version").isNotNull())
        .where(named[0] | named[1])
        .where(up_to_month(installs, "created_at", params.start))
        .select(
            "source",
            "type",
            F.col("user_id").alias("uid"),
            "version",
            second_text("created_at").alias("download_time"),
            F.when(F.col("source") == DEVICE, "").otherwise(F.col("channel")).alias("channel"),
        )
    )


def version_label(code: Column | int, version: Column, params: MonthParams) -> Column:
    """The version with its platform's label in front; NULL stays NULL."""
    code = code if isinstance(code, Column) else F.lit(code)
    label = F.when(code == ANDROID, params.android_label).otherwise(params.iphone_label)
    return F.concat(label, version)


def latest_rows(usable: DataFrame) -> DataFrame:
    """The newest row per source, platform and user; ties go to the greater version, channel.

    Spark keeps one row per key and task before the shuffle (window group limit).
    """
    # The user id comes first: sorting compares most rows by that number alone.
    newest = Window.partitionBy("uid", "type", "source").orderBy(
        *(F.col(name).desc() for name in _RECORD)
    )
    ranked = usable.withColumn("row_number", F.row_number().over(newest))
    return ranked.where(F.col("row_number") == 1).drop("row_number")


def newest(condition: Column) -> Column:
    """The newest record among the rows that meet the condition, as a struct or NULL.

    Same rows as ``latest_rows``, but several conditions share one aggregate.
    """
    return F.max(F.when(condition, F.struct(*_RECORD)))
