"""Output tables: declared columns, Parquet files, whole months replaced at a time."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from monthlens.sources.tables import read_table

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "binary": T.BinaryType(),
}


def _columns(text: str) -> T.StructType:
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The columns of the output tables.
MONTH_USER_STAT = _columns(
    "month_time string, register_number bigint, mau bigint, mau_exclude_register bigint, "
    "exchange_dau bigint, non_exchange_dau bigint, keep_ratio double, new_user_keep_ratio double"
)
CLIENT_VERSION = _columns(
    "uid bigint, android_version string, android_download_time string, android_channel string, "
    "iphone_version string, iphone_download_time string, iphone_channel string"
)
MONTH_CLIENT_VERSION = _columns(
    "mobile_type string, number bigint, total bigint, ratio double"
)
LOGIN_ETL = _columns("uid bigint, month_time string, day_time string, city string")
USER_SETS = _columns("kind string, label string, bucket bigint, bits binary, lost bigint")
INSTALLS = _columns(
    "source string, user_id bigint, type int, version string, created_at string, channel string"
)


def by_month(schema: T.StructType) -> T.StructType:
    """The schema of a table partitioned by ``ds``."""
    return T.StructType([*schema.fields, T.StructField("ds", T.StringType())])


def create_if_missing(
    spark: SparkSession, path: str, schema: T.StructType, partition: str | None = None
) -> None:
    """An empty table where there is none yet; an existing one is left alone."""
    writer = spark.createDataFrame([], schema).write.mode("ignore")
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def has_entries(spark: SparkSession, path: str, besides: str) -> bool:
    """Whether a folder holds anything but the entry of that name."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return False
    return any(status.getPath().getName() != besides for status in files.listStatus(folder))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The table's columns in order; a missing column or another type is an error."""
    for field in schema:
        if field.name not in df.columns:
            raise ValueError(f"column {field.name} is missing")
        found = df.schema[field.name].dataType
        if found != field.dataType:
            raise ValueError(f"column {field.name} is {found}, the table has {field.dataType}")
    return df.select(*schema.fieldNames())


def overwrite_month(
    df: DataFrame, path: str, schema: T.StructType | None, ds: str, partition: str = "ds"
) -> int:
    """Replace one month of a table and leave the others alone; returns the rows written.

    Rows are counted while they are written. An empty result replaces nothing and is an error.
    The month is added last, as a constant, so that Spark does not sort the rows by it.
    """
    rows = df if schema is None else conform(df, schema)
    counted = Observation()
    (
        rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        .withColumn(partition, F.lit(ds))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    written = observed(counted, "rows")
    if not written:
        raise nothing_written(ds)
    return written


def observed(observation: Observation, name: str) -> int:
    """What was counted during a write that has ended.

    Where Spark finds out on the way that there are no rows, it leaves the counting step out and
    the observation has no values.
    """
    try:
        return observation.get[name]
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return 0


def nothing_written(ds: str) -> ValueError:
    return ValueError(f"nothing to write for {ds}")


def overwrite_as_of(df: DataFrame, path: str, schema: T.StructType, ds: str) -> int:
    """Replace the whole table as of a month; returns the rows written.

    The month is a partition of its own, which takes the place of an earlier run's only once all
    of it is written. A run that fails leaves the table as it was, for this month and any other.
    """
    return overwrite_month(df, path, schema, ds)


def read_as_of(spark: SparkSession, path: str, schema: T.StructType, ds: str) -> DataFrame:
    """The table as of a month; an error if no run has written that month."""
    rows = read_month(spark, path, schema, ds)
    if rows.isEmpty():
        raise ValueError(f"there is no table as of {ds}")
    return rows.drop("ds")


def read_month(spark: SparkSession, path: str, schema: T.StructType, ds: str) -> DataFrame:
    """One month of a partitioned table; only that partition is read."""
    return read_table(spark, path, by_month(schema)).where(F.col("ds") == ds)
