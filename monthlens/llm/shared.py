"""Tables, the shared folder and intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthlens.storage import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts its lineage for good."""
    return _written(df, new_path(df.sparkSession, "llm"))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one run that are deleted when a result made from them is stored."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def stored(self, df: DataFrame) -> DataFrame:
        self.paths.append(new_path(self.spark, "scratch"))
        return _written(df, self.paths[-1])

    def result(self, df: DataFrame) -> DataFrame:
        """``df`` stored for good; the tables it was made from go."""
        kept = stored(df)
        self.clear()
        return kept

    def clear(self) -> None:
        for path in self.paths:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.paths = []


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files that no frame needs any more.

    By itself it notices them when the driver's memory is collected, every half hour at the latest.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_key() -> Column:
    """A key that is never null: a row's id and a hash of its text, or its text's digest without id."""
    text = text_or_empty()
    known = F.concat(
        F.lit("i"), F.col("doc_id").cast("string"), F.lit(":"), F.xxhash64(text).cast("string")
    )
    return F.coalesce(known, F.concat(F.lit("t"), F.sha2(text.cast("binary"), 256)))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or that with underscores behind it where a column has it already."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, for functions that run there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="monthlens-")) / "monthlens.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
