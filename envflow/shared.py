"""The folder that the driver and all executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one in local mode where the session names none. A cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="envflow-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str = "stream") -> str:
    """The path of a new folder in the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet to the shared folder and read again: its lineage is cut, and it survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
