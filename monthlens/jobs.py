"""The monthly jobs: read tables, compute, write.

Each takes the paths of its tables, so a scheduler can run them in the order
load-users, load-logins, user-stat, user-report and client-version, client-share,
client-report. Three of them have a variant that does not read what earlier months have read:

* ``load-users-bucketed``, ``load-logins-bucketed``, ``user-stat-bucketed`` keep catalog tables
  stored by user, which meet without a shuffle;
* ``user-sets``, ``user-stat-stored`` keep sets of users, from which a month is reported;
* ``client-merge`` brings the latest clients forward by the installs that have arrived.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession

from monthlens.operators import usersets
from monthlens.params import MonthParams
from monthlens.plans import activity, client_state, clients, etl, month_stat, stored_stat
from monthlens.sinks import bucketed, published, reports, tables as out
from monthlens.sources import tables as src

log = logging.getLogger(__name__)


def load_users(spark: SparkSession, params: MonthParams, users: str, snapshot: str) -> None:
    """Raw registrations of the month into their partition of the snapshot."""
    month = etl.user_snapshot_month(src.read_table(spark, users), params)
    out.overwrite_month(month, snapshot, None, params.label)


def load_users_bucketed(
    spark: SparkSession, params: MonthParams, users: str, snapshot_table: str
) -> None:
    """Raw registrations of the month into a snapshot table stored by user."""
    month = etl.user_snapshot_month(src.read_table(spark, users), params)
    bucketed.overwrite_bucketed_month(month, snapshot_table, "id", params.label)


def _logins(
    spark: SparkSession, params: MonthParams, records: str, blocks: str, counted: Observation
) -> DataFrame:
    raw, ranges = src.read_table(spark, records), src.read_table(spark, blocks)
    month = etl.login_etl(raw, ranges, params, counted)
    return out.conform(month, out.LOGIN_ETL).drop("month_time")


def _report_malformed(params: MonthParams, counted: Observation) -> int:
    malformed = out.observed(counted, "malformed")
    if malformed:
        log.warning("%s: %s logins have no day, and count in no day", params.label, malformed)
    return malformed


def load_logins(
    spark: SparkSession, params: MonthParams, records: str, blocks: str, logins: str
) -> int:
    """Raw logins of the month into their partition of the login table.

    Returns, and reports, how many of them hold a day text that is no date. They are counted
    while the month is written.
    """
    counted = Observation()
    kept = _logins(spark, params, records, blocks, counted)
    out.overwrite_month(kept, logins, None, params.label, partition="month_time")
    return _report_malformed(params, counted)


def load_logins_bucketed(
    spark: SparkSession, params: MonthParams, records: str, blocks: str, logins_table: str
) -> int:
    """Raw logins of the month into a login table stored by user."""
    counted = Observation()
    kept = _logins(spark, params, records, blocks, counted)
    bucketed.overwrite_bucketed_month(kept, logins_table, "uid", params.label, "month_time")
    return _report_malformed(params, counted)


def _write_stat(
    spark: SparkSession,
    params: MonthParams,
    logins: DataFrame,
    signups: DataFrame,
    rest_days: str,
    stat: str,
    stored_by_user: bool = False,
) -> int:
    visits = src.visits_from_logins(logins, params.previous, params.following)
    rest = src.read_table(spark, rest_days)
    row = month_stat.month_user_stat(visits, signups, rest, params, stored_by_user)
    out.create_if_missing(spark, stat, out.by_month(out.MONTH_USER_STAT), "ds")
    out.overwrite_month(row, stat, out.MONTH_USER_STAT, params.label)
    lost = activity.signups_without_id(signups, params).first().lost
    if lost:
        log.warning("%s: %s registrations have no id", params.label, lost)
    return lost


def user_stat(
    spark: SparkSession, params: MonthParams, logins: str, snapshot: str, rest_days: str, stat: str
) -> int:
    """The monthly user statistic into its partition.

    Returns, and reports, how many of the month's registrations have no id: under the rules of
    ``NOT IN``, one of them makes ``mau_exclude_register`` 0.
    """
    table = src.read_table(spark, logins, out.LOGIN_ETL)
    signups = src.read_partitioned(spark, snapshot, "ds")
    return _write_stat(spark, params, table, signups, rest_days, stat)


def user_stat_bucketed(
    spark: SparkSession,
    params: MonthParams,
    logins_table: str,
    snapshot_table: str,
    rest_days: str,
    stat: str,
) -> int:
    """The monthly user statistic from tables stored by user."""
    logins, signups = spark.table(logins_table), spark.table(snapshot_table)
    return _write_stat(spark, params, logins, signups, rest_days, stat, stored_by_user=True)


def user_sets(
    spark: SparkSession, params: MonthParams, logins: str, snapshot: str, sets: str
) -> None:
    """The month's logins and snapshot partition as sets of users."""
    table = src.read_table(spark, logins, out.LOGIN_ETL)
    visits = src.visits_from_logins(table, params.start, params.following)
    signups = src.read_partitioned(spark, snapshot, "ds").where(f"ds = '{params.label}'")
    month = usersets.visit_sets(visits).unionByName(
        usersets.signup_sets(signups, params.time_zone)
    )
    out.overwrite_month(month, sets, out.USER_SETS, params.label)


def user_stat_stored(
    spark: SparkSession, params: MonthParams, sets: str, rest_days: str, stat: str
) -> None:
    """The monthly user statistic from the sets of this and earlier months alone."""
    known = src.read_table(spark, sets, out.by_month(out.USER_SETS))
    row = stored_stat.month_user_stat(
        known.where(f"ds <= '{params.label}'"), src.read_table(spark, rest_days), params
    )
    out.create_if_missing(spark, stat, out.by_month(out.MONTH_USER_STAT), "ds")
    out.overwrite_month(row, stat, out.MONTH_USER_STAT, params.label)


def user_report(spark: SparkSession, params: MonthParams, stat: str, report: str) -> None:
    month = out.read_month(spark, stat, out.MONTH_USER_STAT, params.label)
    reports.write_report(month_stat.active_user_stat(month), report)


def client_version(
    spark: SparkSession, params: MonthParams, device: str, client: str, table: str
) -> None:
    """The latest client of every user, as of the month's end."""
    out.create_if_missing(spark, table, out.by_month(out.CLIENT_VERSION), "ds")
    installs = src.installs(src.read_table(spark, device), src.read_table(spark, client))
    rows = clients.client_version(installs, params)
    out.overwrite_as_of(rows, table, out.CLIENT_VERSION, params.label)


def client_publish(
    spark: SparkSession, params: MonthParams, device: str, client: str, published_table: str
) -> int:
    """The latest client of every user into an unpartitioned table, replaced whole."""
    installs = src.installs(src.read_table(spark, device), src.read_table(spark, client))
    rows = clients.client_version(installs, params)
    return published.publish(rows, published_table, out.CLIENT_VERSION)


def client_merge(
    spark: SparkSession,
    params: MonthParams,
    arrived_device: str,
    arrived_client: str,
    state: str,
    published_table: str,
) -> int:
    """The latest clients brought forward by the installs that arrived since the last run.

    ``state`` has a table per month: the newest installs as of it, and beside them the installs
    that have arrived but belong to later months. A month can be run again; the month before it
    must have been run, unless there is no state yet.
    """
    batch = src.installs(
        src.read_table(spark, arrived_device), src.read_table(spark, arrived_client)
    )
    last = f"{state}/{params.previous:%Y-%m}"
    before = None
    if published.publications(spark, last):
        before = published.read_published(spark, last, client_state.KEPT)
    elif out.has_entries(spark, state, besides=params.label):
        raise ValueError(f"there is no state as of {params.previous:%Y-%m}")
    here = f"{state}/{params.label}"
    kept = client_state.brought_forward(before, batch, params)
    published.publish(kept, here, client_state.KEPT)
    stored = published.read_published(spark, here, client_state.KEPT)
    return published.publish(
        client_state.client_version(stored, params), published_table, out.CLIENT_VERSION
    )


def _write_share(
    spark: SparkSession, params: MonthParams, users: DataFrame, share: str
) -> None:
    out.create_if_missing(spark, share, out.by_month(out.MONTH_CLIENT_VERSION), "ds")
    rows = clients.month_client_version(users)
    out.overwrite_month(rows, share, out.MONTH_CLIENT_VERSION, params.label)


def client_share(spark: SparkSession, params: MonthParams, clients_path: str, share: str) -> None:
    """Platform shares into the month's partition."""
    users = out.read_as_of(spark, clients_path, out.CLIENT_VERSION, params.label)
    _write_share(spark, params, users, share)


def client_share_published(
    spark: SparkSession, params: MonthParams, published_table: str, share: str
) -> None:
    """Platform shares of the published client table into the month's partition."""
    users = published.read_published(spark, published_table, out.CLIENT_VERSION)
    _write_share(spark, params, users, share)


def client_report(spark: SparkSession, params: MonthParams, share: str, report: str) -> None:
    month = out.read_month(spark, share, out.MONTH_CLIENT_VERSION, params.label)
    reports.write_report(clients.active_mobile_ratio(month, params), report)
