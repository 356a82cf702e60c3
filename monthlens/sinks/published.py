"""Tables that are replaced whole and never seen half done.

    path/data/<version>/        the rows of a version, Parquet
    path/published/<n>.<version>   an empty file: version number n is this one

A run writes its rows as a new version, which nobody reads yet, and then creates one empty file.
Creating it is the publication: readers list the folder and take the greatest number, so they see
the old table or the new one. A run that fails leaves the published version as it was. Nothing is
renamed, so the same holds on file systems and object stores.

Of two runs that publish at once under the same number, the greater version name wins; both are
whole. Versions that were replaced stay until ``KEEP`` newer ones are published, so that readers
that began before can end.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from monthlens.sinks.tables import conform, observed
from monthlens.sources.tables import read_table

KEEP = 2


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def publications(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of what has been published and not been deleted, oldest first."""
    files, folder = _files(spark, f"{path}/published")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    pairs = (name.split(".", 1) for name in names if name[:1].isdigit())
    return sorted((int(number), version) for number, version in pairs)


def publish(df: DataFrame, path: str, schema: T.StructType, allow_empty: bool = False) -> int:
    """Replace the table by ``df``; returns the rows written.

    Nothing is published, and an error raised, if a column is missing, writing fails, or there are
    no rows and ``allow_empty`` is not set.
    """
    spark = df.sparkSession
    version, counted = uuid.uuid4().hex, Observation()
    data = f"{path}/data/{version}"
    conform(df, schema).observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(data)
    rows = observed(counted, "rows")
    if not rows and not allow_empty:
        _delete(spark, data)
        raise ValueError(f"nothing to publish in {path}")
    number = max((number for number, _ in publications(spark, path)), default=0) + 1
    files, marker = _files(spark, f"{path}/published/{number:012d}.{version}")
    files.create(marker, False).close()
    _forget_old(spark, path)
    return rows


def _delete(spark: SparkSession, path: str) -> None:
    files, folder = _files(spark, path)
    files.delete(folder, True)


def _forget_old(spark: SparkSession, path: str) -> None:
    """The marker goes before its rows, so that no reader is led to a version half deleted."""
    for number, version in publications(spark, path)[:-KEEP]:
        _delete(spark, f"{path}/published/{number:012d}.{version}")
        _delete(spark, f"{path}/data/{version}")


def read_published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as last published when this is called; an error if it never was."""
    known = publications(spark, path)
    if not known:
        raise ValueError(f"nothing has been published in {path}")
    return read_table(spark, f"{path}/data/{known[-1][1]}", schema)
