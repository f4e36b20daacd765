"""Cutting the lineage of iterative jobs in storage every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Where it is unset a folder is made for a local master only: on a cluster a machine-local folder would be
    lost together with its executor.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="tillspan-")


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of `df`."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder in shared storage for one run of a job."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
