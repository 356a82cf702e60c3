"""Times the pipelines on made-up tables in which one user or address holds a third of the rows.

    python bench_skew.py FOLDER [--rows 60000000] [QUERY ...]

FOLDER is filled once and read afterwards. Results are not written anywhere.
"""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import DataFrame, SparkSession

import bench_unfused
from monthlens import MonthParams
from monthlens.operators.iplookup import with_country
from monthlens.functions.ip import with_ip_number
from monthlens.plans import clients, etl, month_stat
from monthlens.sources import tables

MARCH = MonthParams.for_month("2024-03")
BUSY = MARCH.min_uid + 7


def _user(row: str, users: int) -> str:
    return f"if({row} % 3 = 0, {BUSY}L, {MARCH.min_uid} + pmod(xxhash64({row}, 1), {users}))"


def _time(first: str, row: str, days: int) -> str:
    return f"cast(timestamp'{first}' + make_interval(0,0,0,0,0,0," \
        f" pmod(xxhash64({row}, 2), {days * 86400})) as string)"


def fill(spark: SparkSession, folder: str, rows: int) -> None:
    users = max(rows // 12, 1)
    octets = ", '.', ".join(f"pmod(xxhash64(id, {n}), 256)" for n in range(4))
    made = {
        "records": spark.range(rows).selectExpr(
            f"{_user('id', users)} as userid",
            f"{_time('2024-01-01', 'id', 120)} as recordtime",
            f"if(id % 3 = 1, '10.1.2.3', concat({octets})) as loginip",
        ),
        "users": spark.range(users).selectExpr(
            f"id + {MARCH.min_uid} as id",
            "1672531200000 + pmod(xxhash64(id, 3), 41472000) * 1000 as created_at",
        ),
        "installs": spark.range(rows // 2).selectExpr(
            "if(id % 2 = 0, 'device', 'client') as source",
            f"{_user('id', users)} as user_id",
            "cast(pmod(xxhash64(id, 4), 3) as int) as type",
            "concat(pmod(xxhash64(id, 5), 10), '.', pmod(xxhash64(id, 6), 20)) as version",
            f"{_time('2021-01-01', 'id', 1200)} as created_at",
            "concat('store', pmod(xxhash64(id, 7), 30)) as channel",
        ),
    }
    for name, df in made.items():
        path = f"{folder}/{name}"
        if not os.path.exists(f"{path}/_SUCCESS"):
            df.write.mode("overwrite").parquet(path)


def queries(spark: SparkSession, folder: str) -> dict[str, callable]:
    records, users, installs = (
        spark.read.parquet(f"{folder}/{name}") for name in ("records", "users", "installs")
    )
    rest = spark.sql("select 'CN' as exchange_area, '2024-03-05' as rest_date")
    blocks = spark.range(25).selectExpr(
        "concat('c', id) as cc", "id * 171798692 as lo", "id * 171798692 + 171798691 as hi"
    )

    def visits() -> DataFrame:
        return tables.visits_from_records(records, MARCH, MARCH.previous, MARCH.following)

    def numbered() -> DataFrame:
        return with_ip_number(records.select("userid", "loginip"), "loginip", "ip_num")

    return {
        "month_user_stat": lambda: month_stat.month_user_stat(visits(), users, rest, MARCH),
        "month_user_stat unfused": lambda: bench_unfused.month_user_stat(
            visits(), users, rest, MARCH
        ),
        "month_user_stat_all": lambda: month_stat.month_user_stat_all(
            tables.visits_from_records(records, MARCH), users, rest, MARCH
        ),
        "client_version": lambda: clients.client_version(installs, MARCH),
        "client_version unfused": lambda: bench_unfused.client_version(installs, MARCH),
        "latest_client": lambda: clients.latest_client(installs, MARCH),
        "client_ranks": lambda: clients.client_ranks(installs, MARCH),
        "login_etl": lambda: etl.login_etl(records, blocks, MARCH),
        "ip_country": lambda: with_country(numbered(), blocks),
        "ip_country by shuffle": lambda: with_country(numbered(), blocks, broadcast_bytes=0),
    }


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("folder")
    parser.add_argument("--rows", type=int, default=60_000_000)
    parser.add_argument("query", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "32")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    fill(spark, args.folder, args.rows)
    for name, query in queries(spark, args.folder).items():
        if args.query and name not in args.query:
            continue
        times = []
        for _ in range(2):
            begin = time.perf_counter()
            query().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        print(f"{name}: {min(times):.1f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
