"""Logs of a streaming checkpoint and of a file sink, read as tables."""

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it isn't there.

    A listing of a few files. It asks the file system, as Spark's readers
    skip folders whose name starts with an underscore, such as a sink's log.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def last_batch(spark: SparkSession, path: str) -> int | None:
    """The highest batch id among a folder's log files (`7`, `9.compact`); None without any."""
    found = (re.fullmatch(r"(\d+)(\.compact)?", name) for name in folder_names(spark, path))
    return max((int(x[1]) for x in found if x), default=None)


def offset_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per batch and source: `batch_id, modified, source, offsets` (JSON text).

    An offset file is a version line, a metadata line, then one line per source.
    """
    files = spark.read.text(f"{checkpoint}/offsets", wholetext=True)
    parts = files.select(
        F.col("_metadata.file_name").try_cast("bigint").alias("batch_id"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.posexplode(F.slice(F.split("value", "\n"), 3, 1 << 30)).alias("source", "offsets"),
    )
    return parts.where("batch_id IS NOT NULL AND offsets <> ''")


# A line of a file sink's log, after the version line.
_SINK_LINE = "path string, size bigint, isDir boolean, modificationTime bigint, blockReplication int, blockSize bigint, action string"


def sink_log(spark: SparkSession, path: str) -> DataFrame:
    """The files that a file sink has committed: `path, size, modified, batch_id`.

    Spark writes a log file per batch once the batch is done; now and then one, `9.compact`, holds all lines so far. Read are the newest such
    file and those after it, so neither a folder of the lake is listed nor a file that no batch has committed appears.
    `batch_id` is that of the log file, for older files that of the newest compaction. None of it passes the driver but the log's file names.
    """
    log = f"{path}/_spark_metadata"
    found = [x for x in (re.fullmatch(r"(\d+)(\.compact)?", name) for name in folder_names(spark, log)) if x]
    newest = max((int(x[1]) for x in found if x[2]), default=-1)
    # Spark's file readers refuse such a folder, so its lines are read as text.
    batches = [
        spark.createDataFrame(spark.sparkContext.textFile(f"{log}/{x[0]}"), "string").withColumn("batch_id", F.lit(int(x[1])).cast("bigint"))
        for x in found if int(x[1]) > newest or (x[2] and int(x[1]) == newest)]
    if not batches:
        return spark.createDataFrame([], "path string, size bigint, modified timestamp, batch_id bigint")
    lines = reduce(DataFrame.unionAll, batches).select("batch_id", F.from_json("value", _SINK_LINE).alias("line"))
    return lines.where("line.action = 'add' AND NOT line.isDir").select(
        "line.path", "line.size", F.timestamp_millis("line.modificationTime").alias("modified"), "batch_id")
