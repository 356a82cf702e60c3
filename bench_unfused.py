"""The statistic and the client table in plain SQL shape, for comparison only.

Each figure has its own subquery over the inputs; nothing is shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from monthlens import MonthParams
from monthlens.operators.latest import usable_installs, version_label
from monthlens.operators.marks import CREATED_AT_BOUND
from monthlens.sources.tables import rest_dates

_STAT = """
with now as (select uid from {visits} where month = date'%(start)s'),
before as (select uid from {visits} where month = date'%(previous)s'),
new as (select id from {signups} where created_at < %(bound)s
        and created_at >= %(start_ms)s and created_at < %(end_ms)s),
new_before as (select id from {signups} where created_at < %(bound)s
        and created_at >= %(previous_ms)s and created_at < %(start_ms)s),
days as (select day, count(distinct uid) as dau from {visits}
        where month = date'%(start)s' and day is not null group by day)
select '%(label)s' as month_time, a.n as register_number, b.n as mau, c.n as mau_exclude_register,
       cast(d.n as bigint) as exchange_dau, cast(e.n as bigint) as non_exchange_dau,
       try_divide(f.n, g.n) as keep_ratio, try_divide(h.n, i.n) as new_user_keep_ratio
from (select count(distinct id) as n from {signups} where created_at < %(end_ms)s) a,
     (select count(distinct uid) as n from now) b,
     (select count(distinct uid) as n from now where uid not in (select id from new)) c,
     (select avg(dau) as n from days left join {rest} r using (day)
        where dayofweek(day) between 2 and 6 and r.day is null) d,
     (select avg(dau) as n from days left join {rest} r using (day)
        where dayofweek(day) not between 2 and 6 or r.day is not null) e,
     (select count(distinct uid) as n from before where uid in (select uid from now)) f,
     (select count(distinct uid) as n from before) g,
     (select count(distinct uid) as n from now where uid in (select id from new_before)) h,
     (select count(distinct id) as n from new_before) i
"""

_CLIENTS = """
with latest as (
    select * from (
        select *, row_number() over (partition by source, type, uid
            order by download_time desc, version desc, channel desc) as n from {installs})
    where n = 1),
sides as (
    select coalesce(a.source, i.source) as source, coalesce(a.uid, i.uid) as uid,
           a.version as av, a.download_time as at, a.channel as ac,
           i.version as iv, i.download_time as it, i.channel as ic
    from (select * from latest where type = 1) a
    full join (select * from latest where type = 2) i
      on a.source = i.source and a.uid = i.uid)
select coalesce(c.uid, d.uid) as uid, if(c.uid is null, d.av, c.av) as android_version,
       c.at as android_download_time, c.ac as android_channel,
       if(c.uid is null, d.iv, c.iv) as iphone_version,
       c.it as iphone_download_time, c.ic as iphone_channel
from (select * from sides where source = 'client') c
full join (select * from sides where source = 'device') d on c.uid = d.uid
"""


def month_user_stat(
    visits: DataFrame, signups: DataFrame, rest_days: DataFrame, params: MonthParams
) -> DataFrame:
    values = {
        "label": params.label,
        "start": params.start,
        "previous": params.previous,
        "bound": CREATED_AT_BOUND,
        "previous_ms": params.millis(params.previous),
        "start_ms": params.millis(params.start),
        "end_ms": params.millis(params.following),
    }
    rest = rest_dates(rest_days, params, params.start, params.following)
    return visits.sparkSession.sql(_STAT % values, visits=visits, signups=signups, rest=rest)


def client_version(installs: DataFrame, params: MonthParams) -> DataFrame:
    usable = usable_installs(installs, params)
    labelled = usable.withColumn("version", version_label(usable.type, usable.version, params))
    return installs.sparkSession.sql(_CLIENTS, installs=labelled)


def client_ranks(usable: DataFrame) -> DataFrame:
    """Ranks by a window per user: one task holds all rows of a user."""
    newest = Window.partitionBy("uid", "type", "source").orderBy(F.col("download_time").desc())
    return usable.where("download_time is not null").select(
        "uid",
        "type",
        "source",
        "download_time",
        F.rank().over(newest).cast("bigint").alias("rnk"),
        F.dense_rank().over(newest).cast("bigint").alias("dense_rnk"),
    )
