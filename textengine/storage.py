"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local one is made only where none is named and the master is local."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        have = spark.sparkContext._jsc.sc().getCheckpointDir()
        at = have.get() if have.isDefined() else None
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="textengine-")
        spark.sparkContext.setCheckpointDir(at)
    return at if ":/" in at else f"file://{at}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it goes when the driver ends."""
    parent = f"{shared_dir(spark).rstrip('/')}/textengine/{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{parent}/{name}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """df as a written table in the shared folder: computed once, safe from lost executors, without lineage."""
    at = scratch(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
