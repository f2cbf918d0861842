"""Cutting lineage into the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset in local mode, a folder of this
    driver's own that is remembered for the session and goes with the process; on a cluster, where executors could
    not see such a folder, an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = getattr(spark, "_presswork_dir", None)
        if not found:
            found = spark._presswork_dir = tempfile.mkdtemp(prefix="presswork-")
            atexit.register(shutil.rmtree, found, ignore_errors=True)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: what follows no longer
    depends on the tasks before it, survives a lost executor, and is computed once."""
    path = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
