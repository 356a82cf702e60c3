"""The pipelines' inputs, drawn from order and nation tables.

An order stands for a login of its customer, a customer's first order for the
registration, and an order's priority, status and price for an installed client.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthlens.functions.ip import ip_text
from monthlens.sources.tables import ANDROID, CLIENT, DEVICE, IPHONE, read_table

ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
NATION = "n_nationkey int, n_name string"

# Market holidays, two on weekdays and one on a Saturday, and one of another area.
REST_DAYS = [
    ("CN", "1996-03-08"),
    ("CN", "1996-03-11"),
    ("CN", "1996-03-30"),
    ("US", "1996-03-12"),
]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/orders.parquet", ORDERS)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw logins; the address is spread over all 2**32 by the order's key."""
    address = "pmod(pmod(o_orderkey, 2147483648L) * 2654435761L, 4294967296L)"
    return _orders(spark, sf_dir).selectExpr(
        "o_custkey as userid", "o_orderdate as recordtime", f"{address} as address"
    ).select("userid", "recordtime", ip_text("address").alias("loginip"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw registrations in epoch milliseconds."""
    return _orders(spark, sf_dir).selectExpr("o_custkey as id", "o_orderdate as first").groupBy(
        "id"
    ).agg({"first": "min"}).selectExpr(
        "id", "timestampdiff(millisecond, timestamp_ntz'1970-01-01', `min(first)`) as created_at"
    )


def rest_days(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{area}', '{day}')" for area, day in REST_DAYS)
    return spark.sql(f"select * from values {rows} as t(exchange_area, rest_date)")


def installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device and client installs in one frame."""
    return _orders(spark, sf_dir).selectExpr(
        f"if(o_orderstatus = 'O', '{CLIENT}', '{DEVICE}') as source",
        "o_custkey as user_id",
        f"case o_orderpriority when '1-URGENT' then {ANDROID} when '2-HIGH' then {IPHONE} "
        "else 0 end as type",
        "cast(floor(o_totalprice / 50000) as string) as version",
        "o_orderdate as created_at",
        "if(o_orderstatus = 'O', concat('ch', cast(o_orderkey % 3 as string)), null) as channel",
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 address blocks of equal size, one per nation."""
    return read_table(spark, f"{sf_dir}/nation.parquet", NATION).selectExpr(
        "n_name as cc",
        "n_nationkey * 171798692L as lo",
        "n_nationkey * 171798692L + 171798691L as hi",
    )


def nested_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations' blocks inside one of all addresses, each around two of other nations.

    The inner ones are a block of some /16 networks across two nations' border and, inside that,
    one of 5,000 addresses.
    """
    nations = blocks(spark, sf_dir)
    keyed = read_table(spark, f"{sf_dir}/nation.parquet", NATION)
    inner = keyed.selectExpr(
        "inline(array("
        "struct(concat(n_name, ' 2') as cc, (n_nationkey + 7) % 25 * 171798692L as at, 9000000L as n),"
        "struct(concat(n_name, ' 3') as cc, (n_nationkey + 7) % 25 * 171798692L + 777 as at, 5000L as n)))"
    ).selectExpr(
        "cc", "greatest(at - 1000000L, 0L) as lo", "at - 1000000L + n as hi"
    )
    world = nations.selectExpr("'WORLD' as cc", "0L as lo", "4294967295L as hi").limit(1)
    return world.unionByName(nations).unionByName(inner)
