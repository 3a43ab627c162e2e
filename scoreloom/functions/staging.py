"""Shared-storage staging: cut a lineage with a table every executor can read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else the session's checkpoint directory.

    Where neither is set, a session in local mode gets a folder of its own, registered with the session
    and removed when Python ends. A cluster session without a shared folder is an error: each executor
    would write to its own disk, and later reads would miss those files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="scoreloom-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, label: str = "stage") -> str:
    return f"{staging_root(spark)}/scoreloom-{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back as parquet.

    Everything downstream reads the table instead of recomputing the plan, a
    lost executor costs a re-read and not a re-run, columns stay prunable, and
    the planner knows the true size, so it broadcasts the table only when it is
    under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
