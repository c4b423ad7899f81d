"""Rates of running queries as rows."""

import time
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from iotlake.schemas import PROGRESS


def _row(progress) -> tuple:
    return (
        progress.name, progress.batchId, progress.numInputRows,
        progress.inputRowsPerSecond, progress.processedRowsPerSecond,
    )


def progress_rates(spark: SparkSession, queries: Sequence[StreamingQuery]) -> DataFrame:
    """One row per batch of the given queries, from the reports that Spark keeps on the driver.

    Spark keeps the newest `spark.sql.streaming.numRecentProgressUpdates` of a query. One that may have lost
    reports already is refused, as sums over it would be too low: use a `ProgressLog` there.
    """
    kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    cut = [query.name for query in queries if len(query.recentProgress) >= kept]
    if cut:
        raise ValueError(f"only the newest {kept} reports are kept of {cut}")
    rows = [_row(p) for query in queries for p in query.recentProgress]
    return spark.createDataFrame(rows, PROGRESS)


def progress_offsets(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """End and committed offsets of running topic queries: `query, topic, partition, end_offset, committed`.

    Taken from each query's newest report, so no message is read: the source
    names the topic's latest offsets there beside those of the batch.
    """
    reports = [(query.name, query.lastProgress) for query in queries]
    sources = [
        (name, source.latestOffset, source.endOffset)
        for name, report in reports if report for source in report.sources
    ]
    offsets = "map<string,map<string,bigint>>"
    by_topic = spark.createDataFrame(sources, "query string, latest string, done string").select(
        "query", F.from_json("done", offsets).alias("done"),
        F.explode(F.from_json("latest", offsets)).alias("topic", "ends"))
    by_partition = by_topic.select("query", "topic", "done", F.explode("ends").alias("partition", "end_offset"))
    done = F.try_element_at(F.try_element_at("done", F.col("topic")), F.col("partition"))
    return by_partition.select(
        "query", "topic", F.col("partition").try_cast("int").alias("partition"), "end_offset", done.alias("committed"))


class ProgressLog(StreamingQueryListener):
    """Progress reports of every query of a session, all of them.

    `save` appends the reports since the last save to a table and forgets them, so the driver holds no more than
    arrive between two saves.
    """

    def __init__(self):
        self._rows = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self._rows.append(_row(event.progress))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def wait_for(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Wait until the newest report of a query that has ended is here, as reports arrive on a thread of their own."""
        last, until = query.lastProgress, time.monotonic() + seconds
        while last and not any(row[:2] == (last.name, last.batchId) for row in list(self._rows)):
            if time.monotonic() > until:
                raise TimeoutError(f"no report of batch {last.batchId} of {last.name}")
            time.sleep(0.05)

    def rates(self, spark: SparkSession) -> DataFrame:
        """The reports not saved yet."""
        return spark.createDataFrame(list(self._rows), PROGRESS)

    def save(self, spark: SparkSession, path: str) -> None:
        taken = list(self._rows)
        if taken:
            spark.createDataFrame(taken, PROGRESS).coalesce(1).write.mode("append").parquet(path)
            del self._rows[:len(taken)]
