"""Ranks of a user's installs by time, exact however many installs one user has.

A plain ``rank() over (partition by user ...)`` sends all rows of a user to one task, which is right
while the whole table would fit in a task. Beyond that the rows are sorted once, by ranges of
user and time, so a busy user's rows fill several ranges. Each range ranks its rows as if nothing
came before; only its first user, and that user's first time, can have begun in earlier ranges. What
they bring along is added up over the ranges, a row for each, and put on top. Rows are shuffled once
and joined with nothing but that short list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from monthlens.storage import new_path

_KEYS = ["uid", "type", "source"]  # the user id first, to sort by that number
_COLUMNS = [*_KEYS, "download_time"]
#: Tables up to this size, as Spark estimates it, may have any user's rows in one task.
SMALL_BYTES = 64 << 20


def client_ranks(usable: DataFrame, small_bytes: int | None = None) -> DataFrame:
    """``rnk`` and ``dense_rnk`` of every install, newest first, per source, platform and user."""
    rows = usable.select(*_COLUMNS).where("download_time is not null")
    if _estimated_bytes(rows) <= (SMALL_BYTES if small_bytes is None else small_bytes):
        return _by_window(rows)
    return _by_ranges(rows)


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _by_window(rows: DataFrame) -> DataFrame:
    newest = Window.partitionBy(*_KEYS).orderBy(F.col("download_time").desc())
    return rows.select(
        *_COLUMNS,
        F.rank().over(newest).cast("bigint").alias("rnk"),
        F.dense_rank().over(newest).cast("bigint").alias("dense_rnk"),
    )


def _by_ranges(rows: DataFrame) -> DataFrame:
    """One range sort; ranks within each range, and what the ranges before it add."""
    spark = rows.sparkSession
    order = [*_KEYS, F.col("download_time").desc(), "_salt"]
    # without the salt, rows of one user and second could not be dealt to several ranges
    ranges = (
        rows.withColumn("_salt", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_salt")
        .withColumn("range", F.spark_partition_id())
    )
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranges.schema)
    local = ranges.mapInArrow(
        _ranked_range, f"{types}, rnk long, dense_rnk long, row long, head int"
    )
    path = new_path(spark, "ranks")
    local.write.parquet(path)
    local = spark.read.schema(local.schema).parquet(path)
    offsets = F.broadcast(spark.createDataFrame(_offsets(local)))
    placed = local.join(offsets, "range")
    # head: 2 in the first time of the range's first user, 1 in that user's other times
    above = "case head when 2 then run_before when 1 then rows_before else 0L end"
    return placed.selectExpr(
        *_COLUMNS,
        f"rnk + {above} as rnk",
        "dense_rnk + if(head > 0, times_before, 0L) as dense_rnk",
    )


def _ranked_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks within one sorted range, batch by batch.

    The row before a batch, and where its user and time began, are all that is carried on.
    """
    before, row, rnk, dense, heads = None, 0, 0, 0, 2
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(name) for name in _COLUMNS]
        new_key = np.zeros(n, bool)
        for column in columns[:-1]:
            new_key |= _changes(column)
        new_time = new_key | _changes(columns[-1])
        first = [column[0].as_py() for column in columns]
        new_key[0] = before is None or first[:-1] != before[:-1]
        new_time[0] = before is None or first != before
        at = np.arange(n)
        # the rows before the first change go on from what was carried
        key_from = np.maximum.accumulate(np.where(new_key, at, -1))
        rows = np.where(key_from >= 0, at - key_from + 1, row + at + 1)
        run_from = np.maximum.accumulate(np.where(new_time, at, -1))
        ranks = np.where(run_from >= 0, rows[run_from], rnk)
        times = np.cumsum(new_time)
        denses = times + np.where(key_from >= 0, 1 - times[key_from], dense)
        left = np.cumsum(new_key) > (1 if before is None else 0)
        moved = np.cumsum(new_time) > (1 if before is None else 0)
        head = np.minimum(heads, np.where(left, 0, np.where(moved, 1, 2)))
        before = [column[-1].as_py() for column in columns]
        row, rnk, dense, heads = (int(x[-1]) for x in (rows, ranks, denses, head))
        added = [pa.array(x, pa.int64()) for x in (ranks, denses, rows)] + [pa.array(head, pa.int32())]
        yield pa.record_batch(
            [*batch.columns, *added], names=[*batch.schema.names, "rnk", "dense_rnk", "row", "head"]
        )


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; the first is no change. No nulls."""
    same = np.zeros(len(column), bool)
    if len(column) > 1:
        differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
        same[1:] = differs.to_numpy(zero_copy_only=False)
    return same


_OFFSETS = pa.schema(
    [("range", pa.int32())]
    + [(name, pa.int64()) for name in ("rows_before", "run_before", "times_before")]
)


@dataclass
class _Carried:
    """The last user and time so far: rows and times of the user, rows above the time."""

    key: tuple = ()
    time: str = ""
    rows: int = 0
    times: int = 0
    above: int = 0


def _offsets(local: DataFrame) -> pa.Table:
    """What each range's first user and time have before it; one row per range."""
    names = [*_COLUMNS, "rnk", "dense_rnk", "row", "head"]
    # within a range the sort order is: no head after a head, users ascending, rows ascending
    last = F.max_by(F.struct(*names), F.struct(*_KEYS, "row"))
    first = F.min_by(F.struct(*names), F.struct(*_KEYS, "row"))
    ends = local.groupBy("range").agg(first.alias("first"), last.alias("last")).collect()
    found, carried = [], _Carried()
    for end in sorted(ends, key=lambda end: end.range):
        first, last = end.first, end.last
        goes_on = tuple(first[:3]) == carried.key
        same_time = goes_on and first.download_time == carried.time
        rows = carried.rows if goes_on else 0
        above = carried.above if same_time else rows
        times = (carried.times - same_time) if goes_on else 0
        found.append((end.range, rows, above, times))
        added = {2: above, 1: rows, 0: 0}[last.head]
        carried = _Carried(
            tuple(last[:3]),
            last.download_time,
            last.row + (rows if last.head else 0),
            last.dense_rnk + (times if last.head else 0),
            last.rnk - 1 + added,
        )
    return pa.Table.from_pylist(
        [dict(zip(_OFFSETS.names, row, strict=True)) for row in found], schema=_OFFSETS
    )
