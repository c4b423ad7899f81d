"""State that goes on from window to window of a key: the run's first time and the last time before a window."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from iotlake.functions.event_time import interval_micros
from iotlake.operators.metrics import mean_gap
from iotlake.operators.runs import run_number, with_previous
from iotlake.streaming.recovery import drop_batch, whole_batches


def closed_windows(deliveries: DataFrame, keys: Iterable[str] = ("topic",), width: str = "10 seconds",
                   watermark: str = "10 seconds") -> DataFrame:
    """`*keys, window_start, window_end, n, first_ts, last_ts` of a stream's closed windows."""
    keys = list(keys)
    return deliveries.withWatermark("ts", watermark).groupBy(*keys, F.window("ts", width)).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")).select(
        *keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n", "first_ts", "last_ts")


def for_each_carried(windows: DataFrame, keys: Iterable[str], checkpoint: str, name: str, each: Callable[[DataFrame, int], None],
                     trigger: Mapping[str, object] | None = None, width: str = "10 seconds", last: str = "first_ts",
                     keep: int = 2) -> StreamingQuery:
    """Run `each(rows, batch id)` on the closed windows of every micro-batch, with `run_first` and `previous` added.

    `windows` has one row per key and window, as a windowed aggregation gives them in append mode: once, and no window of a key before an
    earlier one. `run_first` is the key's first `first_ts` of all, `previous` its value of `last` in the window before. What goes on from batch to batch
    is a table of a row per key beside the checkpoint's own logs, one for each batch id; a batch that is run again starts from the
    table of the batch before it, so a restart neither loses nor repeats. The windows of a batch are joined to that table and ordered within
    runs, as `with_previous` does; `each` has to replace what it wrote for the same batch id before.
    """
    keys, spark = list(keys), windows.sparkSession
    base = f"{checkpoint}/carried"

    def carry(batch: DataFrame, number: int) -> None:
        # The batch is read once; all that follows reads what it was.
        batch.drop("window").write.mode("overwrite").parquet(f"{base}/closed/batch={number}")
        closed = spark.read.schema(batch.drop("window").schema).parquet(f"{base}/closed/batch={number}")
        before = [n for n in whole_batches(spark, f"{base}/state") if n < number]
        own = closed.groupBy(*keys).agg(F.min("first_ts").alias("_first"), F.max(last).alias("_last"))
        state = own
        if before:
            state = spark.read.schema(own.schema).parquet(f"{base}/state/batch={before[-1]}")
        old = state.select(*[F.col(k).alias(f"_{k}") for k in keys], "_first", F.col("_last") if before else F.lit(None).alias("_last"))
        rows = closed.withColumn("_run", run_number(closed, "window_start", width, 10_000))
        rows = with_previous(rows, keys, "window_start", "_run", last).drop("_run")
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        firsts = own.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_first").alias("_own")).join(
            old.toDF(*[f"_{c}" for c in old.columns]),
            reduce(Column.__and__, [F.col(f"_{k}").eqNullSafe(F.col(f"__{k}")) for k in keys]), "left").select(
            *[f"_{k}" for k in keys], F.least("_own", "__first").alias("run_first"), F.col("__last").alias("_before"))
        each(rows.join(firsts, same).select(
            *closed.columns, "run_first", F.coalesce("previous", "_before").alias("previous")), number)
        merged = own if not before else state.unionByName(own).groupBy(*keys).agg(
            F.min("_first").alias("_first"), F.max("_last").alias("_last"))
        merged.write.mode("overwrite").parquet(f"{base}/state/batch={number}")
        for n in before[:max(0, len(before) + 1 - keep)]:
            drop_batch(spark, f"{base}/state", n)
            drop_batch(spark, f"{base}/closed", n)

    writer = windows.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(carry)
    return (writer.trigger(**trigger) if trigger else writer).start()


def with_gap(rows: DataFrame) -> DataFrame:
    """Carried windows with `avg_delay`, their mean gap, as `observed_gap` gives it."""
    return rows.withColumn("avg_delay", mean_gap("n", "first_ts", "last_ts", "previous"))


def with_run_elapsed(rows: DataFrame) -> DataFrame:
    """Carried windows with `elapsed_seconds` from the run's first message, as `with_elapsed` gives it."""
    return rows.withColumn("elapsed_seconds", interval_micros(F.col("window_end") - F.col("run_first")) / F.lit(1e6))


def write_gaps(deliveries: DataFrame, path: str, checkpoint: str, name: str, keys: Iterable[str] = ("topic",), width: str = "10 seconds",
               watermark: str = "10 seconds", trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Write the mean gaps and elapsed times of a stream's closed windows, a folder per batch (`batch=<id>`)."""
    def write(rows: DataFrame, number: int) -> None:
        with_run_elapsed(with_gap(rows)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return for_each_carried(
        closed_windows(deliveries, keys, width, watermark), keys, checkpoint, name, write, trigger, width, last="last_ts")
