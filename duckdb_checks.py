"""The registered queries as plain DuckDB SQL, one subquery per figure."""

from __future__ import annotations

from textwrap import dedent

_LOGINS = """
logins as (
    select o_custkey as uid,
           strftime(o_orderdate, '%Y-%m') as month_time,
           strftime(o_orderdate, '%Y-%m-%d') as day_time,
           date_trunc('month', o_orderdate)::date as month,
           o_orderdate::date as day,
           ((o_orderkey % 2147483648) * 2654435761) % 4294967296 as ip_num
    from orders
    where o_custkey between 1 and 10000000000
)"""

_SIGNUPS = """
signups as (
    select o_custkey as id,
           epoch_ms(min(o_orderdate)) as created_at,
           date_trunc('month', min(o_orderdate))::date as month
    from orders
    where o_custkey between 1 and 10000000000
    group by o_custkey
)"""

_SNAPSHOT = """
signups as (
    select o_custkey as id,
           epoch_ms(min(o_orderdate)) as created_at,
           date_trunc('month', min(o_orderdate))::date as month,
           strftime(min(o_orderdate), '%Y-%m') as ds
    from orders
    where o_custkey between 1 and 10000000000
    group by o_custkey
)"""

_REST = """
rest as (
    select distinct rest_date::date as day
    from (values ('CN', '1996-03-08'), ('CN', '1996-03-11'), ('CN', '1996-03-30'),
                 ('US', '1996-03-12')) t(exchange_area, rest_date)
    where exchange_area = 'CN'
)"""

_BLOCKS = """
blocks as (
    select n_name as cc,
           n_nationkey::bigint * 171798692 as lo,
           n_nationkey::bigint * 171798692 + 171798691 as hi
    from nation
)"""

_DAYS = """
days as (
    select month, day, count(distinct uid) as dau from logins group by month, day
)"""

_INSTALLS = """
installs as (
    select case when o_orderstatus = 'O' then 'client' else 'device' end as source,
           case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 end as type,
           o_custkey as uid,
           case o_orderpriority when '1-URGENT' then 'Android ' else 'iPhone ' end
             || floor(o_totalprice / 50000)::bigint::varchar as version,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as download_time,
           case when o_orderstatus = 'O' then 'ch' || (o_orderkey % 3)::varchar else '' end
             as channel
    from orders
    where o_custkey > 0
      and o_orderpriority in ('1-URGENT', '2-HIGH')
      and strftime(o_orderdate, '%Y-%m') <= '2001-07'
)"""

_LATEST = """
latest as (
    select * exclude (n) from (
        select *, row_number() over (
            partition by source, type, uid
            order by download_time desc, version desc, channel desc) as n
        from installs)
    where n = 1
)"""

_SIDES = """
sides as (
    select coalesce(a.source, i.source) as source,
           coalesce(a.uid, i.uid) as uid,
           a.version as android_version,
           a.download_time as android_download_time,
           a.channel as android_channel,
           i.version as iphone_version,
           i.download_time as iphone_download_time,
           i.channel as iphone_channel
    from (select * from latest where type = 1) a
    full join (select * from latest where type = 2) i
      on a.source = i.source and a.uid = i.uid
)"""

_CLIENTS = """
clients as (
    select coalesce(c.uid, d.uid) as uid,
           case when c.uid is null then d.android_version else c.android_version end
             as android_version,
           c.android_download_time,
           c.android_channel,
           case when c.uid is null then d.iphone_version else c.iphone_version end
             as iphone_version,
           c.iphone_download_time,
           c.iphone_channel
    from (select * from sides where source = 'client') c
    full join (select * from sides where source = 'device') d on c.uid = d.uid
)"""

_SHARES = """
counted as (
    select 'ios' as mobile_type, count(distinct uid) as number
    from clients where iphone_version is not null
    union all
    select 'android', count(distinct uid) from clients where android_version is not null
    union all
    select 'both', count(distinct uid) from clients
    where android_version is not null and iphone_version is not null
),
shares as (
    select mobile_type, number, total, number / nullif(total, 0) as ratio
    from counted, (select count(*) as total from clients)
)"""

_TO_CLIENTS = (_INSTALLS, _LATEST, _SIDES, _CLIENTS)

_REGISTERED = "(select count(distinct id) from signups where month <= date '1996-03-01')"
_IN_SNAPSHOT = "(select count(distinct id) from signups where substr(ds, 1, 7) <= '1996-03')"
_MAU = "(select count(distinct uid) from logins where month_time = '1996-03')"
_OLD_USERS = """(
    select count(distinct uid) from logins
    where day_time >= '1996-03-01' and day_time < '1996-04-01'
      and uid not in (select id from signups where month = date '1996-03-01'))"""
_TRADING = """(
    select trunc(avg(dau))::bigint from days left join rest using (day)
    where month = date '1996-03-01' and isodow(day) <= 5 and rest.day is null)"""
_OTHER = """(
    select trunc(avg(dau))::bigint from days left join rest using (day)
    where month = date '1996-03-01' and (rest.day is not null or isodow(day) > 5))"""
_KEPT = """(
    select count(distinct uid) from logins
    where month_time = '1996-02'
      and uid in (select uid from logins where month_time = '1996-03'))"""
_BEFORE = "(select count(distinct uid) from logins where month_time = '1996-02')"
_KEPT_NEW = """(
    select count(distinct uid) from logins
    where month_time = '1996-03'
      and uid in (select id from signups
                  where month = date '1996-02-01' and created_at < 2434028380862))"""
_NEW_BEFORE = """(
    select count(distinct id) from signups
    where month = date '1996-02-01' and created_at < 2434028380862)"""

_STAT = f"""
stat as (
    select '1996-03' as month_time,
           {_REGISTERED} as register_number,
           {_MAU} as mau,
           {_OLD_USERS} as mau_exclude_register,
           {_TRADING} as exchange_dau,
           {_OTHER} as non_exchange_dau,
           {_KEPT} / nullif({_BEFORE}, 0) as keep_ratio,
           {_KEPT_NEW} / nullif({_NEW_BEFORE}, 0) as new_user_keep_ratio
)"""

_ALL_MONTHS = """
active as (select distinct month, uid from logins),
registered as (
    select m.month, count(distinct s.id) as register_number
    from (select distinct month from active) m left join signups s on s.month <= m.month
    group by m.month
),
users as (
    select a.month,
           count(*) as mau,
           count(*) filter (where s.id is null) as mau_exclude_register
    from active a left join signups s on s.id = a.uid and s.month = a.month
    group by a.month
),
means as (
    select month,
           trunc(avg(dau) filter (where rest.day is null and isodow(day) <= 5))::bigint
             as exchange_dau,
           trunc(avg(dau) filter (where rest.day is not null or isodow(day) > 5))::bigint
             as non_exchange_dau
    from days left join rest using (day)
    group by month
),
kept as (
    select (b.month + interval 1 month)::date as month,
           count(a.uid) / nullif(count(*), 0) as keep_ratio
    from active b left join active a
      on a.uid = b.uid and a.month = (b.month + interval 1 month)::date
    group by b.month
),
kept_new as (
    select (s.month + interval 1 month)::date as month,
           count(a.uid) / nullif(count(*), 0) as new_user_keep_ratio
    from signups s left join active a
      on a.uid = s.id and a.month = (s.month + interval 1 month)::date
    group by s.month
)"""


def _sql(parts, body: str) -> str:
    return "with " + ",\n".join(dedent(part).strip() for part in parts) + dedent(body)


def _scalar(parts, **figures: str) -> str:
    columns = ",\n       ".join(f"{text} as {name}" for name, text in figures.items())
    return _sql(parts, f"\nselect '1996-03' as month_time,\n       {columns}")


_NESTED = """
nested as (
    select cc, lo, hi from blocks
    union all select 'WORLD', 0, 4294967295
    union all
    select n_name || ' 2', greatest((n_nationkey + 7) % 25 * 171798692::bigint - 1000000, 0),
           (n_nationkey + 7) % 25 * 171798692::bigint - 1000000 + 9000000
    from nation
    union all
    select n_name || ' 3', greatest((n_nationkey + 7) % 25 * 171798692::bigint - 999223, 0),
           (n_nationkey + 7) % 25 * 171798692::bigint - 999223 + 5000
    from nation
)"""


def statements() -> dict[str, str]:
    known = _statements()
    # other ways to the same results: from stored sets, merged states, written tables, ranges
    same = {
        "register_number_stored": "register_number",
        "mau_stored": "mau",
        "mau_exclude_register_stored": "mau_exclude_register",
        "keep_ratio_stored": "keep_ratio",
        "new_user_keep_ratio_stored": "new_user_keep_ratio",
        "month_user_stat_stored": "month_user_stat",
        "active_user_stat_rescan": "active_user_stat",
        "client_ranks_by_range": "client_ranks",
        "client_version_merged": "client_version",
        "sink_idempotent": "client_version",
        "month_client_version_rescan": "month_client_version",
    }
    return known | {name: known[other] for name, other in same.items()}


def _statements() -> dict[str, str]:
    calendar = (_LOGINS, _DAYS, _REST)
    return {
        "login_etl": _sql(
            (_LOGINS, _BLOCKS),
            """
            select distinct uid, month_time, day_time, cc as city
            from logins left join blocks on ip_num between lo and hi
            where month_time = '1996-03'""",
        ),
        "ip_country": _sql(
            (_BLOCKS,),
            """
            select userid, ip_num, cc
            from (select o_custkey as userid,
                         ((o_orderkey % 2147483648) * 2654435761) % 4294967296 as ip_num
                  from orders)
            left join blocks on ip_num between lo and hi""",
        ),
        "ip_country_nested": _sql(
            (_BLOCKS, _NESTED),
            """
            select any_value(o_custkey) as userid, any_value(ip_num) as ip_num,
                   arg_min(cc, (hi - lo, -lo, cc)) as cc
            from (select *, ((o_orderkey % 2147483648) * 2654435761) % 4294967296 as ip_num
                  from orders)
            left join nested on ip_num between lo and hi
            group by o_orderkey""",
        ),
        "user_snapshot_month": _sql(
            (_SIGNUPS,), "\nselect id, created_at from signups where month = date '1996-03-01'"
        ),
        "register_number": _scalar((_SIGNUPS,), register_number=_REGISTERED),
        "register_number_month": _scalar(
            (_SIGNUPS,),
            register_number="""(
    select count(distinct id) from signups where month = date '1996-03-01')""",
        ),
        "mau": _scalar((_LOGINS,), mau=_MAU),
        "mau_exclude_register": _scalar((_LOGINS, _SIGNUPS), mau_exclude_register=_OLD_USERS),
        "not_in_null_aware": _sql(
            (_LOGINS, _SIGNUPS),
            """
            select month_time,
                   count(distinct uid) filter (where uid not in (
                       select nullif(id, 7) from signups where signups.month = logins.month))
                     as mau_exclude_register
            from logins
            group by month_time""",
        ),
        "dau_by_day": _sql(
            (_LOGINS,),
            """
            select day_time, count(distinct uid) as dau
            from logins where month_time = '1996-03' group by day_time""",
        ),
        "exchange_dau": _scalar(calendar, exchange_dau=_TRADING),
        "non_exchange_dau": _scalar(calendar, non_exchange_dau=_OTHER),
        "keep_ratio": _scalar(
            (_LOGINS,),
            numerator=_KEPT,
            denominator=_BEFORE,
            keep_ratio=f"{_KEPT} / nullif({_BEFORE}, 0)",
        ),
        "new_user_keep_ratio": _scalar(
            (_LOGINS, _SIGNUPS),
            active_again=_KEPT_NEW,
            register_number=_NEW_BEFORE,
            new_user_keep_ratio=f"{_KEPT_NEW} / nullif({_NEW_BEFORE}, 0)",
        ),
        "month_user_stat": _sql((*calendar, _SIGNUPS, _STAT), "\nselect * from stat"),
        "month_user_stat_ds": _sql(
            (*calendar, _SNAPSHOT, _STAT.replace(_REGISTERED, _IN_SNAPSHOT)),
            "\nselect * from stat",
        ),
        "active_user_stat": _sql(
            (*calendar, _SIGNUPS, _STAT),
            """
            select * replace (round(keep_ratio, 4) as keep_ratio,
                              round(new_user_keep_ratio, 4) as new_user_keep_ratio)
            from stat""",
        ),
        "month_user_stat_all": _sql(
            (*calendar, _SIGNUPS, _ALL_MONTHS),
            """
            select strftime(month, '%Y-%m') as month_time,
                   register_number, mau, mau_exclude_register, exchange_dau, non_exchange_dau,
                   keep_ratio, new_user_keep_ratio
            from users join registered using (month) left join means using (month)
            left join kept using (month) left join kept_new using (month)""",
        ),
        "latest_client": _sql(
            (_INSTALLS, _LATEST),
            "\nselect source, type, uid, version, download_time, channel from latest",
        ),
        "client_ranks": _sql(
            (_INSTALLS,),
            """
            select source, type, uid, download_time,
                   rank() over newest_first as rnk,
                   dense_rank() over newest_first as dense_rnk
            from installs
            window newest_first as (partition by source, type, uid order by download_time desc)
            """,
        ),
        "client_by_source": _sql((_INSTALLS, _LATEST, _SIDES), "\nselect * from sides"),
        "client_version": _sql(_TO_CLIENTS, "\nselect * from clients"),
        "month_client_version": _sql((*_TO_CLIENTS, _SHARES), "\nselect * from shares"),
        "active_mobile_ratio": _sql(
            (*_TO_CLIENTS, _SHARES),
            """
            select '2001-07' as ds, mobile_type, number, total, round(ratio, 4) as ratio
            from shares""",
        ),
    }
