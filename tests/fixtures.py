"""Small inputs with results worked out by hand."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession

from monthlens import MonthParams


BASE = 1_000_000_000
MARCH = MonthParams.for_month("2024-03", android_label="A", iphone_label="I")


def millis(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp()) * 1000


USERS = [
    (BASE + 1, millis("2024-01-10")),
    (BASE + 2, millis("2024-02-05")),
    (BASE + 3, millis("2024-02-20")),
    (BASE + 4, millis("2024-03-02")),
    (BASE + 5, millis("2024-03-15")),
    (BASE + 6, millis("2024-04-01")),
    (BASE + 7, 9999999999999),
]
_LOGINS = {
    1: "02-03 08:00 03-01 09:00 03-01 10:00 03-04 08:00 03-05 08:00 03-06 08:00",
    2: "02-06 08:00 03-01 08:00 03-05 08:00 03-06 08:00",
    3: "02-21 08:00 04-01 00:00",
    4: "03-04 08:00 03-09 08:00",
    5: "03-06 08:00",
    9: "02-10 08:00 03-04 08:00",
    -1: "03-06 08:00",
}
RECORDS = [
    (BASE + n, f"2024-{day} {time}:00", f"10.0.0.{abs(n)}")
    for n, text in _LOGINS.items()
    for day, time in zip(text.split()[::2], text.split()[1::2])
]
REST_DAYS = [("CN", "2024-03-05"), ("US", "2024-03-06")]
STAT = {
    "month_time": "2024-03",
    "register_number": 5,
    "mau": 5,
    "mau_exclude_register": 3,
    "exchange_dau": 2,
    "non_exchange_dau": 1,
    "keep_ratio": 0.75,
    "new_user_keep_ratio": 0.5,
}

DEVICE_INSTALLS = [
    (1, 1, "1.0", "2024-01-01 00:00:00"),
    (1, 1, "1.1", "2024-02-01 00:00:00"),
    (1, 1, "9.9", "2024-04-01 00:00:00"),
    (2, 1, "1.0", "2024-01-05 00:00:00"),
    (3, 2, "2.0", "2024-01-06 00:00:00"),
    (4, 3, "5", "2024-01-01 00:00:00"),
    (0, 1, "1.0", "2024-01-01 00:00:00"),
    (-5, 1, "1.0", "2024-01-01 00:00:00"),
    (None, 1, "1.0", "2024-01-01 00:00:00"),
    (8, 1, "1.0", None),
    (8, None, "1.0", "2024-01-01 00:00:00"),
]
CLIENT_INSTALLS = [
    (1, 1, "1.2", "2024-02-10 00:00:00", "storeA"),
    (1, 2, "2.1", "2024-02-11 00:00:00", "storeB"),
    (2, 2, "2.2", "2024-03-01 12:00:00.123", "storeC"),
    (5, 1, "", "2024-03-02 00:00:00", "storeA"),
    (6, 1, None, "2024-03-02 00:00:00", "storeA"),
]
CLIENTS = [
    (1, "A1.2", "2024-02-10 00:00:00", "storeA", "I2.1", "2024-02-11 00:00:00", "storeB"),
    (2, None, None, None, "I2.2", "2024-03-01 12:00:00", "storeC"),
    (3, None, None, None, "I2.0", None, None),
    (5, "A", "2024-03-02 00:00:00", "storeA", None, None, None),
]
SHARES = [("ios", 3, 4, 0.75), ("android", 2, 4, 0.5), ("both", 1, 4, 0.25)]


def users(spark: SparkSession, rows=USERS):
    return spark.createDataFrame(rows, "id bigint, created_at bigint")


def records(spark: SparkSession, rows=RECORDS):
    return spark.createDataFrame(rows, "userid bigint, recordtime string, loginip string")


def rest_days(spark: SparkSession, rows=REST_DAYS):
    return spark.createDataFrame(rows, "exchange_area string, rest_date string")


def device_installs(spark: SparkSession, rows=DEVICE_INSTALLS):
    return spark.createDataFrame(
        rows, "user_id bigint, type int, version string, created_at string"
    )


def client_installs(spark: SparkSession, rows=CLIENT_INSTALLS):
    return spark.createDataFrame(
        rows, "user_id bigint, type int, version string, created_at string, channel string"
    )


def blocks(spark: SparkSession, rows):
    return spark.createDataFrame(rows, "cc string, lo bigint, hi bigint")


def install_frame(spark: SparkSession, rows):
    """Rows of (source, user, type, version, time, channel)."""
    return spark.createDataFrame(
        rows,
        "source string, user_id bigint, type int, version string, created_at string, "
        "channel string",
    )


