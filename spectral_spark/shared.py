"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir. Where that is unset, local mode gets a temporary folder; a cluster is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def bound_batches(spark: SparkSession) -> None:
    """Hold the Arrow batches that Python workers get to a few MB, however long texts and arrays are. This sets an option of the session, which stays: plans read it when they run."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet into the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
