"""Windowed producer metrics and their conversion to samples."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from iotlake.functions.event_time import interval_micros, micros_of
from iotlake.functions.labels import label_map
from iotlake.operators.runs import run_number, with_previous

# Gauge names.
LAMBDA = "kafka_producer_lambda"
MESSAGE_RATE = "kafka_producer_message_rate"
DROPPED_MESSAGES = "kafka_producer_dropped_messages"
ERROR_RATE = "kafka_producer_error_rate"
AVG_DELAY = "kafka_producer_avg_delay"

# Metric column behind each gauge.
GAUGES = {
    MESSAGE_RATE: "rate",
    DROPPED_MESSAGES: "dropped_count",
    ERROR_RATE: "error_rate",
    AVG_DELAY: "avg_delay",
}

# Gauges a stopping client sets to zero; the dropped count keeps its last value.
ZEROED_ON_STOP = (MESSAGE_RATE, ERROR_RATE, AVG_DELAY)

# How each client family counts drops: a failed send of the first is a drop,
# the second never counts one.
KPYTHON = "kpython"
CKAFKA = "ckafka"


def producer_metrics(deliveries: DataFrame, keys: Iterable[str] = ("topic", "client_id"),
                     width: str = "10 seconds", family: str = KPYTHON,
                     watermark: str | None = None) -> DataFrame:
    """Count, rate, errors, drops and mean planned delay per key and window.

    Every aggregate combines in the scanning task, so a hot topic sends one row
    per task and window through the shuffle. A stream needs `watermark` to
    close windows; its `ts` must be a timestamp with zone.
    """
    keys = list(keys)
    if family not in (KPYTHON, CKAFKA):
        raise ValueError(f"unknown family: {family!r}")
    if watermark:
        deliveries = deliveries.withWatermark("ts", watermark)
    counted = deliveries.groupBy(*keys, F.window("ts", width)).agg(
        F.count(F.lit(1)).alias("msg_count"),
        F.count_if(F.col("status") == "error").alias("error_count"),
        F.sum("planned_delay").alias("delay_sum"),
        F.min("ts").alias("first_ts"),
    )
    seconds = interval_micros(F.col("window.end") - F.col("window.start")) / F.lit(1e6)
    dropped = F.col("error_count") if family == KPYTHON else F.lit(0).cast("bigint")
    return counted.select(
        *keys,
        "window",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *_rates(seconds, dropped),
        "first_ts",
    )


def _rates(seconds: Column, dropped: Column) -> list[Column]:
    """The metric columns of `msg_count`, `error_count` and `delay_sum` of a window so many seconds long."""
    return [
        F.col("msg_count"),
        (F.col("msg_count").cast("double") / seconds).alias("rate"),
        F.col("error_count"),
        (F.col("error_count").cast("double") / seconds).alias("error_rate"),
        dropped.alias("dropped_count"),
        F.when(F.col("msg_count") == 0, F.lit(0.0))
        .otherwise(F.coalesce("delay_sum", F.lit(0.0)) / F.col("msg_count"))
        .alias("avg_delay"),
    ]


def late_errors(sends: DataFrame, reports: DataFrame, keys: Iterable[str] = ("topic", "client_id"),
                within: str = "5 minutes", watermark: str | None = None) -> DataFrame:
    """`*keys, ts`: the failed deliveries of accepted sends, at the time of their report.

    `sends` has `message_id, ts, status` and the keys, `reports` has `message_id, ts, status`. A report belongs to the send of its id if it
    comes no more than `within` after it. On streams both sides need `watermark`: a send is kept for as long as
    a report may come, and only failed deliveries are kept of the reports.
    """
    keys = list(keys)
    sent = sends.where("status <> 'refused'").select(*keys, F.col("message_id").alias("_sent"), F.col("ts").alias("_at"))
    failed = reports.where("status = 'error'").select("message_id", "ts")
    if watermark:
        sent, failed = sent.withWatermark("_at", watermark), failed.withWatermark("ts", watermark)
    in_time = F.expr(f"_sent = message_id AND ts >= _at AND ts <= _at + INTERVAL {within}")
    return sent.join(failed, in_time).select(*keys, "ts")


def reported_metrics(sends: DataFrame, reports: DataFrame, keys: Iterable[str] = ("topic", "client_id"),
                     width: str = "10 seconds", within: str = "5 minutes", watermark: str | None = None) -> DataFrame:
    """Window metrics of a client that learns of an error by a delivery report, later than it sends.

    A message counts in the window it is sent in, an error in the window its report comes in, which may be one without any message. A
    refused send (a full buffer) counts nowhere; one that is never reported counts as sent. This family never counts
    drops. Batch and stream give the same windows; a stream's close once the watermark has passed them by `within`, as
    an error may still be told until then.
    """
    keys = list(keys)
    sent = sends.where("status <> 'refused'").select(
        *keys, "ts", F.lit(1).alias("_sent"), F.lit(0).alias("_failed"), F.col("planned_delay").alias("_delay"))
    if watermark:
        sent = sent.withWatermark("ts", watermark)
    failed = late_errors(sends, reports, keys, within, watermark).select(
        *keys, "ts", F.lit(0).alias("_sent"), F.lit(1).alias("_failed"), F.lit(None).cast("double").alias("_delay"))
    counted = sent.unionByName(failed).groupBy(*keys, F.window("ts", width)).agg(
        F.sum("_sent").alias("msg_count"), F.sum("_failed").alias("error_count"), F.sum("_delay").alias("delay_sum"))
    seconds = interval_micros(F.col("window.end") - F.col("window.start")) / F.lit(1e6)
    return counted.select(
        *keys, "window", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *_rates(seconds, F.lit(0).cast("bigint")))


def unreported(sends: DataFrame, reports: DataFrame, within: str = "5 minutes", watermark: str | None = None) -> DataFrame:
    """The accepted sends that no report has come for `within` their time; a stream gives each once that is certain."""
    sent = sends.where("status <> 'refused'")
    told = reports.select(F.col("message_id").alias("_of"), F.col("ts").alias("_at"))
    if watermark:
        sent, told = sent.withWatermark("ts", watermark), told.withWatermark("_at", watermark)
    in_time = F.expr(f"_of = message_id AND _at >= ts AND _at <= ts + INTERVAL {within}")
    return sent.join(told, in_time, "left_outer").where("_of IS NULL").select(*sends.columns)


def observed_gap(deliveries: DataFrame, keys: Iterable[str] = ("topic",),
                 width: str = "10 seconds", run: int = 10_000) -> DataFrame:
    """Mean gap between consecutive messages of a key, per window of the later one.

    Stands in for the planned delay where none is recorded. The gaps that end in
    a window add up to its last time minus the last time before it, so messages
    are first reduced to three numbers per key and window. Those rows are ordered within a key and a
    run of `run` windows, and the last time of each run, one row a run, is handed to the next; so a key with
    years of windows is spread over its runs. The very first message of a key has no gap.
    """
    keys = list(keys)
    windows = (
        deliveries.groupBy(*keys, F.window("ts", width))
        .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))
        .select(*keys, F.col("window.start").alias("window_start"), "n", "first", "last")
    )
    windows = windows.withColumn("_run", run_number(windows, "window_start", width, run))
    spanned = with_previous(windows, keys, "window_start", "_run", "last")
    return spanned.select(*keys, "window_start", "n", mean_gap("n", "first", "last", "previous").alias("avg_delay"))


def mean_gap(n: str, first: str, last: str, previous: str) -> Column:
    """Mean gap of the messages of a window, in seconds; null where there is none."""
    span = F.col(last) - F.coalesce(previous, first)
    gaps = F.col(n) - F.when(F.col(previous).isNull(), 1).otherwise(0)
    return F.when(gaps > 0, interval_micros(span) / F.lit(1e6) / gaps)


def with_elapsed(metrics: DataFrame, run: Iterable[str] = ("topic",)) -> DataFrame:
    """Add seconds from the run's first message to the window's end (batch only).

    The run starts are a grouping of their own, joined back: a window over
    `run` would put all windows of a busy topic into one task.
    """
    run = list(run)
    starts = metrics.groupBy(*[F.col(c).alias(f"_{c}") for c in run]).agg(F.min("first_ts").alias("_start"))
    # Null-safe, so that windows of a missing key are kept.
    same_run = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in run])
    elapsed = interval_micros(F.col("window_end") - F.col("_start")) / F.lit(1e6)
    return metrics.join(starts, same_run).select(*metrics.columns, elapsed.alias("elapsed_seconds"))


def current_lambda(controls: DataFrame, clamp: bool = True) -> DataFrame:
    """Newest readable control value per topic; `clamp` lifts negatives to zero.

    Two values of one instant resolve to the larger, if they differ by more than a
    millionth. One grouping: time and value are packed into one decimal, a fixed-width value, so
    it hashes in place and combines in the scanning task; a topic costs a row a task.
    """
    return clamped(newest_lambda(controls).select("topic", "lambda")) if clamp else newest_lambda(controls).select("topic", "lambda")


def newest_lambda(controls: DataFrame) -> DataFrame:
    """`topic, lambda, rank`: the newest readable value per topic, and the number that orders such values.

    On a stream in update mode this is a row of state per topic, given again whenever a newer value comes.
    """
    known = controls.where("lambda IS NOT NULL").select("topic", "ts", "lambda")
    value = F.when(F.isnan("lambda"), 5e9).otherwise(F.greatest(F.least(F.col("lambda"), F.lit(4e9)), F.lit(-4e9)))
    order = (
        micros_of(known, "ts").cast("decimal(19,0)") * F.lit("10000000000000000000").cast("decimal(20,0)")
        + ((value + 5e9) * 1e8).cast("decimal(19,0)")
    )
    return known.groupBy("topic").agg(F.max_by("lambda", order).alias("lambda"), F.max(order).alias("rank"))


def clamped(newest: DataFrame) -> DataFrame:
    """Values that are negative or no number as zero."""
    positive = (F.col("lambda") > 0) & ~F.isnan("lambda")
    return newest.withColumn("lambda", F.when(positive, F.col("lambda")).otherwise(F.lit(0.0)))


def to_samples(metrics: DataFrame, label_columns: Iterable[str] = ("topic", "client_id"),
               gauges: dict[str, str] = GAUGES, at: str = "window_end") -> DataFrame:
    """Window metrics as samples: one row per gauge, labels from `label_columns`.

    A sample has the time of its window's end. With `at="window"` it is the last
    microsecond inside the window, which still carries a stream's watermark.
    """
    time = F.window_time("window") if at == "window" else F.col(at)
    values = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(column).cast("double").alias("value"))
        for name, column in gauges.items()
    ])
    labels = label_map({name: F.col(name) for name in label_columns})
    return metrics.select(time.alias("ts"), labels.alias("labels"), F.inline(values)).select(
        "ts", "metric", "labels", "value"
    )


def lambda_samples(controls: DataFrame, clamp: bool = True) -> DataFrame:
    """Control values as samples of the lambda gauge."""
    value = F.col("lambda")
    if clamp:
        value = F.when((value > 0) & ~F.isnan(value), value).otherwise(F.lit(0.0))
    return controls.where("lambda IS NOT NULL").select(
        "ts", F.lit(LAMBDA).alias("metric"),
        label_map({"topic": F.col("topic")}).alias("labels"), value.alias("value"),
    )


def stop_samples(samples: DataFrame, after: str = "2 seconds", gap: str | None = None,
                 watermark: str | None = None) -> DataFrame:
    """One zero per zeroed gauge of every series, `after` its last sample.

    With `gap` a client stops whenever a gauge has had no sample for so long, so a series gets a zero for each time that it stops
    and none while it goes on: its samples are grouped into sessions. That also works on a stream with `watermark`, which gives the
    zero once the session can't go on any more. A batch first keeps the first and the last sample of each series and slot of `gap`, as samples within
    a slot are of one session, so no series is ordered in one task by its samples. A stream can't group twice, so there samples of different times are
    ordered in one task a series; `spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition` moves that to the scanning tasks.
    """
    gauges = samples.where(F.col("metric").isin(*ZEROED_ON_STOP))
    if watermark:
        gauges = gauges.withWatermark("ts", watermark)
    if gap is None:
        last = gauges.groupBy("metric", "labels").agg(F.max("ts").alias("last"))
    else:
        # Sessions are merged in order of their keys, and maps have none.
        gauges = gauges.select("metric", F.array_sort(F.map_entries("labels")).alias("_labels"), "ts")
        if not gauges.isStreaming:
            slots = gauges.where("ts IS NOT NULL").groupBy("metric", "_labels", F.window("ts", gap)).agg(
                F.min("ts").alias("_first"), F.max("ts").alias("_last"))
            gauges = slots.select("metric", "_labels", F.explode(F.array("_first", "_last")).alias("ts"))
        last = (
            gauges.groupBy("metric", "_labels", F.session_window("ts", gap)).agg(F.max("ts").alias("last"))
            .withColumn("labels", F.map_from_entries("_labels"))
        )
    return last.select((F.col("last") + F.expr(f"INTERVAL {after}")).alias("ts"), "metric", "labels", F.lit(0.0).alias("value"))


def with_stop_zeros(samples: DataFrame, after: str = "2 seconds", gap: str | None = None) -> DataFrame:
    """The samples and the closing zeros of all their series (batch only)."""
    return samples.unionByName(stop_samples(samples, after, gap))
