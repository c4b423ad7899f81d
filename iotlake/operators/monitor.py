"""Completeness checks: what topics hold, what was committed, what was written."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from iotlake.sources.checkpoint import last_batch, offset_log, sink_log


def topics(envelopes: DataFrame) -> DataFrame:
    """The topics present."""
    return envelopes.select("topic").distinct()


def describe_topics(envelopes: DataFrame) -> DataFrame:
    """Number of partitions seen per topic."""
    return envelopes.groupBy("topic").agg(F.count_distinct("partition").alias("partitions"))


def end_offsets(envelopes: DataFrame) -> DataFrame:
    """The next offset to be written, per topic and partition."""
    return envelopes.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))


def recent_batches(spark: SparkSession, checkpoint: str, n: int = 3) -> DataFrame:
    """All lines of the `n` newest batches of a checkpoint's offset log, and whether each batch was committed.

    Spark writes a batch's offsets before it runs and its commit after it.
    """
    log = offset_log(spark, checkpoint)
    newest = log.select("batch_id").distinct().orderBy(F.desc("batch_id")).limit(n)
    done = last_batch(spark, f"{checkpoint}/commits")
    return log.join(newest, "batch_id", "left_semi").withColumn(
        "committed", F.col("batch_id") <= F.lit(-1 if done is None else done))


def committed_offsets(spark: SparkSession, checkpoint: str, query: str) -> DataFrame:
    """`query, topic, partition, committed, planned`: offsets a topic query has reached.

    The log keeps the end of each batch as `{"topic": {"partition": next}}`. `committed` is that of the
    newest batch that finished, null before the first one does; `planned` is that of the newest batch begun.
    """
    done = last_batch(spark, f"{checkpoint}/commits")
    log = offset_log(spark, checkpoint).withColumn("done", F.col("batch_id") <= F.lit(-1 if done is None else done))
    newest = log.groupBy("source").agg(
        F.max_by("offsets", "batch_id").alias("planned"),
        F.max_by("offsets", F.when(F.col("done"), F.col("batch_id"))).alias("committed"))
    offsets = "map<string,map<string,bigint>>"
    by_topic = newest.select(
        F.from_json("committed", offsets).alias("reached"), F.explode(F.from_json("planned", offsets)).alias("topic", "at"))
    by_partition = by_topic.select("reached", "topic", F.explode("at").alias("partition", "planned"))
    reached = F.try_element_at(F.try_element_at("reached", F.col("topic")), F.col("partition"))
    return by_partition.select(
        F.lit(query).alias("query"), "topic", F.col("partition").try_cast("int").alias("partition"),
        reached.alias("committed"), "planned")


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """End minus committed offset; a partition never committed lags in full.

    Both sides have one row per topic and partition, so no hint is needed:
    Spark broadcasts the smaller one when its measured size allows.
    """
    done = F.coalesce("committed", F.lit(0).cast("bigint"))
    return ends.join(committed.select("topic", "partition", "committed"), ["topic", "partition"], "left").select(
        "topic", "partition", "end_offset", done.alias("committed"),
        (F.col("end_offset") - done).alias("lag"),
    )


def newest_files(spark: SparkSession, path: str, n: int = 2) -> DataFrame:
    """`path, modified, size`: the `n` newest data files of a lake.

    Of a streamed lake these are files that its sink has committed, from the sink's log; no folder of the lake is listed. A lake
    that was written as a batch has no log: there Spark lists its folders, and opens no file.
    """
    if last_batch(spark, f"{path}/_spark_metadata") is not None:
        files = sink_log(spark, path).select("path", "modified", "size")
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
            "path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    return files.orderBy(F.desc("modified"), "path").limit(n)


def partition_counts(rows: DataFrame) -> DataFrame:
    """Rows per date and hour."""
    return rows.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("n"))
