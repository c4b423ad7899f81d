"""Where a job may write intermediate tables and checkpoints."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's `spark.checkpoint.dir`.

    Only a session that names no shared folder (a local test) falls back to the
    machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        # `local-cluster` has executors of their own folders, as a cluster has.
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="iotlake-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = shared_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
