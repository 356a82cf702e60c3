"""Run one monthly job: ``spark-submit`` this file's module, or ``python -m monthlens``.

    python -m monthlens user-stat --month 2024-03 \\
        --logins /tables/login_etl --snapshot /tables/user_snapshot \\
        --rest-days /tables/rest_day --stat /tables/month_user_stat
"""

from __future__ import annotations

import argparse
import inspect
from datetime import date

from pyspark.sql import SparkSession

from monthlens import jobs
from monthlens.params import MonthParams

JOBS = {
    job.__name__.replace("_", "-"): job
    for job in (
        jobs.load_users,
        jobs.load_users_bucketed,
        jobs.load_logins,
        jobs.load_logins_bucketed,
        jobs.user_sets,
        jobs.user_stat,
        jobs.user_stat_bucketed,
        jobs.user_stat_stored,
        jobs.user_report,
        jobs.client_version,
        jobs.client_publish,
        jobs.client_merge,
        jobs.client_share,
        jobs.client_share_published,
        jobs.client_report,
    )
}
_DEFAULTS = MonthParams.for_month("2000-01")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="monthlens")
    commands = top.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        command = commands.add_parser(name, help=(inspect.getdoc(job) or "").split("\n")[0])
        command.add_argument("--month", help="reported month YYYY-MM; last month if left out")
        command.add_argument("--time-zone", default=_DEFAULTS.time_zone)
        command.add_argument("--min-uid", type=int, default=_DEFAULTS.min_uid)
        command.add_argument("--max-uid", type=int, default=_DEFAULTS.max_uid)
        command.add_argument("--exchange-area", default=_DEFAULTS.exchange_area)
        command.add_argument("--android-label", default=_DEFAULTS.android_label)
        command.add_argument("--iphone-label", default=_DEFAULTS.iphone_label)
        for path in _paths(job):
            command.add_argument("--" + path.replace("_", "-"), required=True)
    return top


def _paths(job) -> list[str]:
    return list(inspect.signature(job).parameters)[2:]


def main(argv: list[str] | None = None) -> None:
    args = vars(parser().parse_args(argv))
    job = JOBS[args.pop("job")]
    paths = [args.pop(path) for path in _paths(job)]
    month = args.pop("month")
    params = (
        MonthParams.for_month(month, **args) if month else MonthParams.run_on(date.today(), **args)
    )
    spark = SparkSession.builder.appName(f"monthlens {job.__name__}").getOrCreate()
    job(spark, params, *paths)


if __name__ == "__main__":
    main()
