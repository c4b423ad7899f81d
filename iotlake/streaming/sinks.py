"""Lake, console and log writers."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from iotlake.operators.metrics import clamped
from iotlake.schemas import METRICS_LOG, PARTITION_COLUMNS
from iotlake.streaming.carried import for_each_carried, with_run_elapsed
from iotlake.streaming.recovery import check_batches, check_recovery, drop_batch, whole_batches


def _gather(rows: DataFrame, files: int) -> DataFrame:
    """Bring each date and hour to at most `files` tasks, its rows spread evenly over them.

    The share is drawn, as the rows of a hot partition may all be equal; with a
    fixed seed a task that runs again draws the same.
    """
    share = F.floor(F.rand(seed=0) * files)
    return rows.withColumn("_share", share).repartition(*PARTITION_COLUMNS, "_share").drop("_share")


def write_lake(rows: DataFrame, fmt: str, path: str, checkpoint: str, name: str,
               trigger: Mapping[str, object] | None = None, files: int | None = None) -> StreamingQuery:
    """Append a stream to a date/hour-partitioned lake, exactly once.

    There is no watermark and no state: late events go to their own partition.
    A micro-batch is map-only, and every task writes a file per partition it
    touches. Give `trigger={"processingTime": ...}` for fewer, larger files, or
    `{"availableNow": True}` to drain and stop; the default runs back to back.
    With many tasks set `files`: one shuffle per micro-batch then leaves at most
    that many files per partition, and still splits a partition that is large.
    """
    check_recovery(rows.sparkSession, path, checkpoint)
    if files:
        rows = _gather(rows, files)
    writer = (
        rows.writeStream.format(fmt)
        .queryName(name)
        .outputMode("append")
        .partitionBy(*PARTITION_COLUMNS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def write_lake_batch(rows: DataFrame, fmt: str, path: str, mode: str = "errorifexists",
                     cluster: bool = True) -> None:
    """Write a batch to a new lake path, for backfill and for rewriting small files.

    `cluster` gathers each date and hour before the write, so that a task does
    not open a file in every partition. It is a rebalance, not a repartition:
    adaptive execution splits a partition that is too large, such as a null
    partition full of bad payloads, and merges small ones.
    """
    if cluster:
        rows = rows.hint("rebalance", *PARTITION_COLUMNS)
    rows.write.format(fmt).mode(mode).partitionBy(*PARTITION_COLUMNS).save(path)


def write_console(rows: DataFrame, trigger: Mapping[str, object] | None = None, shown: int = 20) -> StreamingQuery:
    """Print the first `shown` rows of every micro-batch, each in full; the others are left out.

    For looking at a topic: the rows pass the driver.
    """
    writer = rows.writeStream.format("console").outputMode("append").option("truncate", False).option("numRows", shown)
    return (writer.trigger(**trigger) if trigger else writer).start()


def metrics_log(metrics: DataFrame, keep: Iterable[str] = ("topic",)) -> DataFrame:
    """Window metrics in the log's columns and precision."""
    digits = {"elapsed_seconds": 2, "rate": 2, "avg_delay": 4}
    columns = [
        F.round(c, digits[c]).alias(c) if c in digits else F.col(c)
        for c in METRICS_LOG.fieldNames()
    ]
    return metrics.select(*columns, *keep)


def write_metrics_csv(metrics: DataFrame, path: str, run: str, mode: str = "errorifexists", batch: int = 0) -> None:
    """Write a batch of one run's window log as CSV with a header, one folder per topic.

    `metrics` has `elapsed_seconds`, from `with_elapsed`.
    """
    metrics_log(metrics).write.mode(mode).partitionBy("topic").option("header", True).csv(f"{path}/run={run}/batch={batch}")


def stream_metrics_csv(metrics: DataFrame, path: str, checkpoint: str, run: str,
                       trigger: Mapping[str, object] | None = None, width: str = "10 seconds") -> StreamingQuery:
    """Append the closed windows of a metrics stream, keyed by topic, to one run's CSV log.

    The run's first message of a topic is carried on from batch to batch. Every micro-batch writes a folder of its own, named by
    run and batch id: a batch that is run again, as after a failure, replaces itself, so each window is logged once.
    """
    check_batches(metrics.sparkSession, f"{path}/run={run}", checkpoint)

    def log(rows: DataFrame, batch: int) -> None:
        write_metrics_csv(with_run_elapsed(rows), path, run, "overwrite", batch)

    return for_each_carried(metrics, ["topic"], checkpoint, f"metrics_log_{run}", log, trigger, width)


def upsert_lambda(newest: DataFrame, path: str, checkpoint: str, name: str,
                  trigger: Mapping[str, object] | None = None, keep: int = 2) -> StreamingQuery:
    """Keep a table of one row per topic at its newest control value, from a stream of `newest_lambda`.

    The stream's update mode gives the topics that have had a value. Each micro-batch merges them into the table of the batch
    before and writes that under its own batch id, so a batch that is run again replaces itself, and older values that come late change
    nothing. Readers take the newest whole table, by `read_lambda`; the last `keep` tables are kept.
    """
    spark = newest.sparkSession
    check_batches(spark, path, checkpoint)

    def merge(rows: DataFrame, batch: int) -> None:
        before = [n for n in whole_batches(spark, path) if n < batch]
        if before:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{path}/batch={before[-1]}"))
        merged = rows.groupBy("topic").agg(F.max_by("lambda", "rank").alias("lambda"), F.max("rank").alias("rank"))
        merged.write.mode("overwrite").parquet(f"{path}/batch={batch}")
        for old in before[:max(0, len(before) + 1 - keep)]:
            drop_batch(spark, path, old)

    writer = (
        newest.writeStream.queryName(name).outputMode("update")
        .option("checkpointLocation", checkpoint).foreachBatch(merge)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_lambda(spark: SparkSession, path: str, clamp: bool = True) -> DataFrame:
    """`topic, lambda` of the newest whole table that `upsert_lambda` has written."""
    batches = whole_batches(spark, path)
    if not batches:
        return spark.createDataFrame([], "topic string, lambda double")
    newest = spark.read.parquet(f"{path}/batch={batches[-1]}").select("topic", "lambda")
    return clamped(newest) if clamp else newest
