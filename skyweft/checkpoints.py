"""Cutting the lineage of iterative operators, in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import tempfile

from pyspark.sql import DataFrame, SparkSession

_own: list[tempfile.TemporaryDirectory] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it. Where that is unset a session on one machine gets a temporary folder
    that ends with the process; on a cluster that is an error, as executors would write where nobody else reads."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all of {master} shares")
    if not _own:
        _own.append(tempfile.TemporaryDirectory(prefix="skyweft-"))
        atexit.register(_own[0].cleanup)
    return f"file://{_own[0].name}"


def cut(df: DataFrame) -> DataFrame:
    """df from a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
