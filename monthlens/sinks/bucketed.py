"""Tables stored by user: the rows of a user lie in one bucket of each month.

Two such tables with the same number of buckets meet without a shuffle, and so does an aggregate
per user. The number of buckets is fixed when the table is made and kept by the catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from monthlens.sinks.tables import nothing_written, observed

#: For tables of a few hundred GB a month; a multiple of the cores is a good choice.
BUCKETS = 200


def overwrite_bucketed_month(
    df: DataFrame, table: str, user: str, ds: str, partition: str = "ds"
) -> int:
    """Replace one month of a catalog table bucketed by ``user``; returns the rows written.

    The table is made by the first month. One task writes one bucket, so a month has as many
    files as buckets. An empty result replaces nothing and is an error.
    """
    spark = df.sparkSession
    made = spark.catalog.tableExists(table)
    buckets = bucket_count(spark, table) if made else BUCKETS
    if made:
        df = df.select(*(name for name in spark.table(table).columns if name != partition))
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows")).repartition(buckets, user)
    writer = rows.withColumn(partition, F.lit(ds)).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if made:
        writer.insertInto(table)
    else:
        writer.format("parquet").partitionBy(partition).bucketBy(buckets, user).sortBy(
            user
        ).saveAsTable(table)
    written = observed(counted, "rows")
    if not written:
        if not made:
            spark.sql(f"drop table {table}")
        raise nothing_written(ds)
    return written


def bucket_count(spark, table: str) -> int:
    described = spark.sql(f"describe table extended {table}").collect()
    return next(int(row.data_type) for row in described if row.col_name == "Num Buckets")
