"""The folder for tables that one run writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where none is named, a local session gets a temporary folder of this machine; on a cluster
    that is an error, as other machines do not see such a folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="monthlens-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/monthlens-{name}-{uuid.uuid4().hex}"
