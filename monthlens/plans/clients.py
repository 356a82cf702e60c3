"""Latest Android and iPhone client per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from monthlens.operators.latest import latest_rows, newest, usable_installs, version_label
from monthlens.operators.ranks import client_ranks as rank_installs
from monthlens.params import MonthParams
from monthlens.sources.tables import ANDROID, CLIENT, DEVICE, IPHONE

_PLATFORMS = {"android": ANDROID, "iphone": IPHONE}


def latest_client(installs: DataFrame, params: MonthParams) -> DataFrame:
    """The newest install per source, platform and user."""
    rows = latest_rows(usable_installs(installs, params))
    return rows.select(
        "source",
        "type",
        "uid",
        version_label(F.col("type"), F.col("version"), params).alias("version"),
        "download_time",
        "channel",
    )


def client_ranks(installs: DataFrame, params: MonthParams) -> DataFrame:
    """Rank and dense rank of every install by time."""
    ranked = rank_installs(usable_installs(installs, params))
    return ranked.select("source", "type", "uid", "download_time", "rnk", "dense_rnk")


def _platform_columns(prefix: str, version: Column, record: str, params: MonthParams):
    code = _PLATFORMS[prefix]
    return [
        version_label(code, version, params).alias(f"{prefix}_version"),
        F.col(f"{record}.download_time").alias(f"{prefix}_download_time"),
        F.col(f"{record}.channel").alias(f"{prefix}_channel"),
    ]


def client_by_source(installs: DataFrame, params: MonthParams) -> DataFrame:
    """Per source and user, the newest Android and iPhone install side by side."""
    latest = usable_installs(installs, params).groupBy("uid", "source").agg(
        *(newest(F.col("type") == code).alias(name) for name, code in _PLATFORMS.items())
    )
    columns = [
        column
        for name in _PLATFORMS
        for column in _platform_columns(name, F.col(f"{name}.version"), name, params)
    ]
    return latest.select("source", "uid", *columns)


def newest_by_source(usable: DataFrame) -> DataFrame:
    """Per user the newest install of each source and platform, as structs."""
    return usable.groupBy("uid").agg(
        *(
            newest((F.col("source") == source) & (F.col("type") == code)).alias(f"{source}_{name}")
            for source in (CLIENT, DEVICE)
            for name, code in _PLATFORMS.items()
        )
    )


def from_newest(latest: DataFrame, params: MonthParams) -> DataFrame:
    """The client table from the newest installs per user."""
    in_client = F.coalesce(*(F.col(f"{CLIENT}_{name}.version") for name in _PLATFORMS)).isNotNull()
    columns = []
    for name in _PLATFORMS:
        version = F.when(in_client, F.col(f"{CLIENT}_{name}.version")).otherwise(
            F.col(f"{DEVICE}_{name}.version")
        )
        columns += _platform_columns(name, version, f"{CLIENT}_{name}", params)
    return latest.select("uid", *columns)


def client_version(installs: DataFrame, params: MonthParams) -> DataFrame:
    """One row per user over both sources; the client table wins.

    A user who is in the client table takes everything from there, so a platform known to
    the device table alone is not shown. A user known to the device table alone keeps the
    versions but has no time and no channel.
    """
    return from_newest(newest_by_source(usable_installs(installs, params)), params)


def month_client_version(clients: DataFrame) -> DataFrame:
    """Users with an iOS client, an Android client and both, against all rows.

    Users are counted once each; this adds no shuffle to the plan of ``client_version``.
    """
    android = F.col("android_version").isNotNull()
    ios = F.col("iphone_version").isNotNull()
    users = clients.groupBy("uid").agg(
        F.max(ios).alias("ios"),
        F.max(android).alias("android"),
        F.max(ios & android).alias("both"),
        F.count(F.lit(1)).alias("rows"),
    )
    known = F.col("uid").isNotNull()
    counted = users.agg(
        *(F.count_if(known & F.col(name)).alias(name) for name in ("ios", "android", "both")),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
    )
    shares = counted.select(
        F.stack(
            F.lit(3),
            F.lit("ios"), F.col("ios"),
            F.lit("android"), F.col("android"),
            F.lit("both"), F.col("both"),
        ).alias("mobile_type", "number"),
        "total",
    )
    return shares.withColumn("ratio", F.try_divide("number", "total"))


def active_mobile_ratio(shares: DataFrame, params: MonthParams) -> DataFrame:
    """The shares as reported, with the month in front and the ratio to four places."""
    return shares.select(
        F.lit(params.label).alias("ds"),
        "mobile_type",
        "number",
        "total",
        F.round("ratio", 4).alias("ratio"),
    )
