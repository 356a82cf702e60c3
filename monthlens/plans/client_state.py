"""The client table brought forward by a month, without the history of installs.

The state keeps, per user, the newest install of each source and platform: what the client table is
made from, and all that later installs need to be compared with. A month's run takes the state as
of the month before and the installs that have arrived since. Taking the newest of two newest rows
is the same whatever their order, so rows that arrive months late change the state as if they had
come in time, and a batch that is read twice changes nothing.

An install dated after the month must not count in it and may not be lost. Such rows are kept aside
and are read with the next month's batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from monthlens.functions.dates import in_zone
from monthlens.operators.latest import usable_installs
from monthlens.params import MonthParams
from monthlens.plans.clients import from_newest, newest_by_source
from monthlens.sinks.tables import INSTALLS
from monthlens.sources.tables import due_later

_RECORD = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("download_time", "version", "channel")]
)
_RECORDS = ["client_android", "client_iphone", "device_android", "device_iphone"]
#: The columns of the state.
CLIENT_STATE = T.StructType(
    [T.StructField("uid", T.LongType()), *(T.StructField(name, _RECORD) for name in _RECORDS)]
)


#: A month's table: the state, and in rows of their own the installs of later months.
KEPT = T.StructType([*CLIENT_STATE.fields, T.StructField("later", INSTALLS)])


def state_of(installs: DataFrame, params: MonthParams) -> DataFrame:
    """The state that a batch of installs alone gives."""
    newest = newest_by_source(usable_installs(installs, params))
    uid = F.col("uid").cast("bigint").alias("uid")
    return newest.select(uid, *(F.col(name).cast(_RECORD).alias(name) for name in _RECORDS))


def merged(states: list[DataFrame]) -> DataFrame:
    """One state from several: per user the newest of each record, in one shuffle."""
    rows = states[0]
    for state in states[1:]:
        rows = rows.unionByName(state)
    return rows.groupBy("uid").agg(*(F.max(name).alias(name) for name in _RECORDS))


def _as_text(installs: DataFrame, params: MonthParams) -> DataFrame:
    """Installs with the types of ``INSTALLS``; times as the texts they would be compared as."""
    local = in_zone(installs, "created_at", params.time_zone)
    return local.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in INSTALLS))


def brought_forward(
    before: DataFrame | None, installs: DataFrame, params: MonthParams
) -> DataFrame:
    """The table as of the month: see ``KEPT``.

    ``installs`` is what has arrived since the month before; ``before`` is that month's table, and
    None at first.
    """
    arrived = _as_text(installs, params)
    states = []
    if before is not None:
        arrived = arrived.unionByName(before.where("later is not null").select("later.*"))
        states = [newest_of(before)]
    newest = merged([*states, state_of(arrived, params)])
    later = due_later(arrived, params).select(F.struct(*INSTALLS.fieldNames()).alias("later"))
    rows = newest.unionByName(later, allowMissingColumns=True)
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in KEPT))


def newest_of(kept: DataFrame) -> DataFrame:
    """The state without the rows kept aside."""
    return kept.where("later is null").select(*CLIENT_STATE.fieldNames())


def client_version(kept: DataFrame, params: MonthParams) -> DataFrame:
    """The client table as of the month of the kept rows."""
    return from_newest(newest_of(kept), params)
