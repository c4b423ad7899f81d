"""The registered queries: each takes a session and a table folder."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from iotlake.functions.event_time import instant, utc_wall
from iotlake.functions.labels import label
from iotlake.operators import client_windows as opened
from iotlake.operators import decode, metrics, monitor, rules, series
from iotlake.plans import inputs
from iotlake.plans.jobs import lake_rows as to_lake_rows
from iotlake.scratch import shared_dir
from iotlake.sources.checkpoint import sink_log
from iotlake.sources.lake import read_lake, read_lake_between
from iotlake.sources.metrics_log import read_metrics_csv
from iotlake.sources.replay import replay
from iotlake.streaming import carried, progress, sinks

# `events` holds one row every few minutes or less, so windows and steps of an
# hour stand in for the ten and two seconds of a live run.
WIDTH = "1 hour"
# How late a delivery report may come; a client without a sample for that long has stopped.
REPORTED, STOPPED = "90 minutes", "1 hour"

EVENT_COLUMNS = ["device_id", "battery_level", "motion_detected", "timestamp"]


def _drain(query) -> None:
    query.awaitTermination()


# Decoding


def lake_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_lake_rows(inputs.envelopes(inputs.events(spark, sf_dir)))


def lake_rows_utc_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_lake_rows(inputs.envelopes(inputs.events(spark, sf_dir)), keys="utc")


def lake_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.partition_counts(lake_rows(spark, sf_dir))


def tail_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode.to_text(inputs.envelopes(inputs.events(spark, sf_dir)))
    return rows.withColumn("timestamp", utc_wall(F.col("timestamp")))


def damaged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of damaged messages: nothing is dropped, bad fields are null."""
    return to_lake_rows(inputs.damaged_envelopes(inputs.events(spark, sf_dir)))


def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the null partition, with the raw text of those that did not parse."""
    envelopes = inputs.damaged_envelopes(inputs.events(spark, sf_dir))
    parsed = decode.decode(envelopes, corrupt=True, keep=["topic", "partition", "offset"])
    return decode.malformed(decode.with_partitions(parsed)).select(
        "topic", "partition", "offset", *EVENT_COLUMNS, F.col(decode.CORRUPT_COLUMN).alias("raw"))


def dedup_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode(decode.dedup_payloads(inputs.resent_envelopes(inputs.events(spark, sf_dir))))


def _raw(payloads: DataFrame) -> DataFrame:
    """Each payload's text and what is read of it."""
    return decode.decode(payloads.withColumn("raw", F.col("value").cast("string")), keep=["raw"])


def dedup_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct damaged payloads: those that cannot be read stay apart."""
    return _raw(decode.dedup_payloads(inputs.damaged_envelopes(inputs.events(spark, sf_dir))))


def odd_time_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of events whose time names no zone, has no minutes, no date or only a date."""
    return to_lake_rows(inputs.odd_time_envelopes(inputs.events(spark, sf_dir))).select("device_id", "timestamp", "date", "hour")


# Producer metrics


def _metrics(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return metrics.producer_metrics(inputs.deliveries(inputs.events(spark, sf_dir)), width=WIDTH, **options)


def producer_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir).select(
        "topic", "client_id", "window_start", "msg_count", "rate", "error_count", "error_rate", "dropped_count")


def producer_topic_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed by topic alone, as the other client family reports."""
    return _metrics(spark, sf_dir, keys=["topic"], family=metrics.CKAFKA).select(
        "topic", "window_start", "msg_count", "rate", "error_count", "error_rate", "dropped_count")


def planned_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir).select("topic", "client_id", "window_start", "msg_count", "avg_delay")


def producer_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.observed_gap(inputs.deliveries(inputs.events(spark, sf_dir)), ["topic"], "1 day")


def reported_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors in the windows of their delivery reports; refused sends nowhere."""
    events = inputs.events(spark, sf_dir)
    return _reported(metrics.reported_metrics(inputs.sends(events), inputs.reports(events), width=WIDTH, within=REPORTED))


def _reported(found: DataFrame) -> DataFrame:
    return found.select("topic", "client_id", "window_start", "msg_count", "rate", "error_count", "error_rate", "dropped_count", "avg_delay")


def unreported_sends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted sends without a report in time."""
    events = inputs.events(spark, sf_dir)
    return metrics.unreported(inputs.sends(events), inputs.reports(events), REPORTED).select("topic", "client_id", "ts", "message_id")


def client_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that each client opens at the message that closed the one before."""
    sent = inputs.deliveries(inputs.events(spark, sf_dir), "event_id")
    return opened.client_windows(sent, width=WIDTH, tie="event_id")


def run_elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.with_elapsed(_metrics(spark, sf_dir)).select(
        "topic", "client_id", "window_start", "elapsed_seconds")


def lambda_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.current_lambda(inputs.controls(inputs.events(spark, sf_dir)))


def lambda_current_unclamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.current_lambda(inputs.controls(inputs.events(spark, sf_dir)), clamp=False)


def lambda_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metrics.lambda_samples(inputs.controls(inputs.events(spark, sf_dir)))
    return rows.select("ts", "metric", label("topic").alias("topic"), "value")


def _flat(samples: DataFrame) -> DataFrame:
    """Samples with their labels as columns, as map columns have no SQL order."""
    return samples.select(
        "ts", "metric", label("topic").alias("topic"), label("client_id").alias("client_id"), "value")


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(metrics.to_samples(_metrics(spark, sf_dir, family=metrics.CKAFKA)))


def stop_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(metrics.with_stop_zeros(metrics.to_samples(_metrics(spark, sf_dir))))


# Series


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.samples(inputs.events(spark, sf_dir))


def _stepped(spark: SparkSession, sf_dir: str, equals: dict[str, str] | None = None,
             matches: dict[str, str] | None = None) -> DataFrame:
    chosen = series.select_series(_samples(spark, sf_dir), metrics.MESSAGE_RATE, equals, matches)
    return series.per_step(chosen, WIDTH, tie="event_id")


def sampled_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    stepped = series.per_step(_samples(spark, sf_dir), WIDTH, tie="event_id")
    return stepped.select(
        "step", "metric", label("topic").alias("topic"), label("client_id").alias("client_id"),
        label("impl").alias("impl"), "value")


def rate_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.sum_by(_stepped(spark, sf_dir), "topic", scale=2)


def rate_by_topic_impl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.sum_by(_stepped(spark, sf_dir), "topic", "impl", scale=2)


def rate_by_topic_impl_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _stepped(spark, sf_dir, {"topic": "topic-json"}, {"impl": "(ckafka|kpython)"})
    return series.sum_by(chosen, "topic", "impl", scale=2)


def rate_by_impl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.sum_by(_stepped(spark, sf_dir, {"topic": "topic-json"}), "impl", scale=2)


def series_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-client rate panel: one topic, a label pattern, a time range ending at a given instant."""
    chosen = series.select_series(
        _samples(spark, sf_dir), metrics.MESSAGE_RATE, {"topic": "topic-json"}, {"impl": "ckafka|kpython|"})
    recent = series.time_range(chosen, "2024-01-15 12:00:00", minutes=24 * 60)
    return series.with_display_name(recent, "client_id").select(
        "ts", "series", label("impl").alias("impl"), "value", "event_id")


def error_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = series.select_series(_samples(spark, sf_dir), metrics.ERROR_RATE, {"topic": "topic-parq"})
    return series.with_display_name(chosen, "client_id").select("ts", "series", "value", "event_id")


def label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    scraped = inputs.scraped(inputs.events(spark, sf_dir))
    return series.label_values(scraped, metrics.MESSAGE_RATE, "topic", "impl", "instance", targets=series.TARGETS)


def error_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error panel: one topic and a pattern of implementations."""
    chosen = series.select_series(
        _samples(spark, sf_dir), metrics.ERROR_RATE, {"topic": "topic-json"}, {"impl": "ckafka|kpython"})
    return chosen.select("ts", label("client_id").alias("client_id"), label("impl").alias("impl"), "value", "event_id")


def value_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value of a gauge and the increase of a counter, per hour: error rates are taken for counters here."""
    kind = F.when(F.col("metric") == metrics.ERROR_RATE, "COUNTER").otherwise("GAUGE")
    found = series.per_type(inputs.one_per_instant(_samples(spark, sf_dir)), WIDTH, kind, scale=2)
    return found.select("step", "metric", "type", label("topic").alias("topic"), label("client_id").alias("client_id"),
                        label("impl").alias("impl"), "value")


def scraped_impl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of both client families, told apart by the labels of their jobs."""
    scraped = inputs.scraped(inputs.events(spark, sf_dir))
    labelled = series.with_listed_targets(scraped)
    return labelled.select(
        "ts", "event_id", "value", label("job").alias("job"), label("instance").alias("instance"),
        label("topic").alias("topic"), label("impl").alias("impl"))


def target_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples joined to the targets they came from; the targets add or replace `impl`."""
    samples = _samples(spark, sf_dir).withColumn("job", F.concat(F.lit("producer-"), label("topic")))
    labelled = series.with_target_labels(samples, inputs.targets(inputs.events(spark, sf_dir)))
    return labelled.select(
        "ts", "metric", "event_id", label("impl").alias("impl"), label("exported_impl").alias("exported_impl"),
        label("job").alias("job_label"))


# Names


def _named(rows: DataFrame) -> DataFrame:
    return rows.select(
        "ts", "value", "rule", F.col("name").alias("metric"), "type",
        *[label(n).alias(n) for n in ("topic", "partition", "client_id", "gc_collector")])


def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.bean_samples(inputs.events(spark, sf_dir))
    return _named(rules.normalize_names(rows, rules.BROKER_RULES))


def normalize_names_specific(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.bean_samples(inputs.events(spark, sf_dir))
    return _named(rules.normalize_names(rows, rules.BROKER_RULES, rules.MOST_SPECIFIC))


def normalize_coordination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.coordination_samples(inputs.events(spark, sf_dir))
    return rules.normalize_names(rows, rules.COORDINATION_RULES).select(
        "ts", "value", "rule", F.col("name").alias("metric"), "type")


_RULE_LABELS = ("topic", "partition", "client_id", "gc_collector", "network_processor", "request")


def _of_every_rule(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    found = rules.normalize_names(inputs.every_bean(inputs.events(spark, sf_dir)), rules.BROKER_RULES, mode)
    return found.select("event_id", "value", "rule", F.col("name").alias("metric"), "type", *[label(n).alias(n) for n in _RULE_LABELS])


def normalize_every_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name for each broker rule; the general rules 1 and 4 hide six others."""
    return _of_every_rule(spark, sf_dir, rules.FIRST_MATCH)


def normalize_every_rule_specific(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same names; every rule fires."""
    return _of_every_rule(spark, sf_dir, rules.MOST_SPECIFIC)


def normalize_every_coordination_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.every_coordination_bean(inputs.events(spark, sf_dir))
    return rules.normalize_names(rows, rules.COORDINATION_RULES).select(
        "event_id", "value", "rule", F.col("name").alias("metric"), "type")


# Completeness


def topic_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.topics(inputs.envelopes(inputs.events(spark, sf_dir)))


def topic_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.describe_topics(inputs.envelopes(inputs.events(spark, sf_dir)))


def end_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.end_offsets(inputs.envelopes(inputs.events(spark, sf_dir)))


def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.events(spark, sf_dir)
    done = monitor.end_offsets(inputs.envelopes(events.where("ts < timestamp_ntz'2024-01-25'")))
    return monitor.consumer_lag(
        monitor.end_offsets(inputs.envelopes(events)), done.withColumnRenamed("end_offset", "committed"))


# Streams and files


def replay_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages stored as envelopes, replayed as a stream and written as text."""
    base = shared_dir(spark, "replay")
    inputs.envelopes(inputs.events(spark, sf_dir)).write.parquet(f"{base}/in")
    query = (
        decode.to_text(replay(spark, f"{base}/in")).writeStream.format("parquet").outputMode("append")
        .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start()
    )
    _drain(query)
    return spark.read.parquet(f"{base}/out").withColumn("timestamp", utc_wall(F.col("timestamp")))


def _stream_lake(spark: SparkSession, sf_dir: str, fmt: str) -> str:
    """Stream all messages into a lake; its path."""
    base = shared_dir(spark, f"lake-{fmt}")
    rows = to_lake_rows(inputs.envelopes(inputs.events_stream(spark, sf_dir)))
    _drain(sinks.write_lake(rows, fmt, f"{base}/out", f"{base}/checkpoint", f"lake-{fmt}", {"availableNow": True}))
    return f"{base}/out"


def lake_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lake(spark, _stream_lake(spark, sf_dir, "json"), "json")


def lake_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lake(spark, _stream_lake(spark, sf_dir, "parquet"), "parquet")


def lake_damaged_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages written clustered as a batch and read back."""
    path = f"{shared_dir(spark, 'lake-damaged')}/out"
    sinks.write_lake_batch(damaged_rows(spark, sf_dir), "parquet", path)
    return read_lake(spark, path, "parquet")


def lake_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake rows of an event-time range that starts and ends inside an hour."""
    path = f"{shared_dir(spark, 'lake-range')}/out"
    sinks.write_lake_batch(lake_rows(spark, sf_dir), "parquet", path)
    return read_lake_between(
        spark, path, "parquet", datetime(2024, 1, 10, 3, 30), datetime(2024, 1, 12, 7, 15))


def lake_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one date and local hour."""
    path = f"{shared_dir(spark, 'lake-hour')}/out"
    sinks.write_lake_batch(lake_rows(spark, sf_dir), "json", path)
    return read_lake(spark, path, "json", date="2024-01-15", hour=21)


def newest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest files of a lake that four runs have streamed: the dates and hours that the last of them wrote."""
    path = _lake_of_parts(spark, sf_dir, "newest", files=1)
    # One file a partition, and as many as the last run has written.
    n = sink_log(spark, path).where("batch_id = 3").count()
    found = monitor.newest_files(spark, path, n)
    return found.select(
        F.regexp_extract("path", "/date=([^/]*)/", 1).cast("date").alias("date"),
        F.regexp_extract("path", "/hour=([^/]*)/", 1).cast("int").alias("hour"))


def _in_parts(spark: SparkSession, sf_dir: str, base: str):
    """The events as a stream whose folders come one before each of four runs, in order of time; the first has those without a time."""
    rows, path = inputs.events(spark, sf_dir), f"{base}/events"
    part = F.coalesce(F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3)), F.lit(0))
    for number in range(4):
        rows.where(part == number).write.parquet(f"{path}/part-{number}")
        yield inputs.events_stream_of(spark, path)


def _stream_decoded(spark: SparkSession, sf_dir: str, name: str):
    """Stream all messages through the decoder without storing them; each run's query is yielded once it has ended."""
    base = shared_dir(spark, name)
    for stream in _in_parts(spark, sf_dir, base):
        query = (
            to_lake_rows(inputs.envelopes(stream))
            .writeStream.format("noop").queryName(name).option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start()
        )
        _drain(query)
        yield query, f"{base}/checkpoint"


def recent_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest batches of a checkpoint that four runs have written."""
    *_, (_, checkpoint) = _stream_decoded(spark, sf_dir, "recent")
    return monitor.recent_batches(spark, checkpoint).select("batch_id", "source", "committed")


def progress_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a stream as the progress reports of all its runs count them."""
    runs = [query for query, _ in _stream_decoded(spark, sf_dir, "progress")]
    return progress.progress_rates(spark, runs).groupBy("name").agg(
        F.sum("numInputRows").alias("input_rows"))


def progress_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the reports that a listener has saved to a table after each run."""
    log, path = progress.ProgressLog(), f"{shared_dir(spark, 'progress-log')}/reports"
    spark.streams.addListener(log)
    try:
        for query, _ in _stream_decoded(spark, sf_dir, "logged"):
            log.wait_for(query)
            log.save(spark, path)
    finally:
        spark.streams.removeListener(log)
    return spark.read.parquet(path).where("name = 'logged'").groupBy("name").agg(
        F.sum("numInputRows").alias("input_rows"), F.max("batchId").alias("last_batch"))


def stream_producer_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows a metrics stream has closed once all messages are read."""
    base = shared_dir(spark, "rate")
    rows = inputs.deliveries(inputs.events_stream(spark, sf_dir)).withColumn("ts", instant(F.col("ts")))
    closed = metrics.producer_metrics(rows, width=WIDTH, watermark="10 seconds")
    query = (
        closed.select("topic", "client_id", "window_start", "msg_count", "rate", "error_count", "avg_delay")
        .writeStream.format("parquet").outputMode("append")
        .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start()
    )
    _drain(query)
    written = spark.read.parquet(f"{base}/out")
    return written.withColumn("window_start", utc_wall(F.col("window_start")))


def stream_dedup_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct payloads of a stream in which failed messages are sent twice."""
    base = shared_dir(spark, "dedup")
    sent = inputs.resent_envelopes(inputs.events_stream(spark, sf_dir))
    rows = decode.decode(decode.dedup_stream(sent.withColumnRenamed("timestamp", "sent_at"), "sent_at", "1 day"))
    query = (
        rows.select(*EVENT_COLUMNS).writeStream.format("parquet").outputMode("append")
        .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start()
    )
    _drain(query)
    return spark.read.parquet(f"{base}/out")


def stream_dedup_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct damaged payloads of a stream in four batches and two runs on one checkpoint."""
    base = shared_dir(spark, "dedup-damaged")
    for stream in _in_parts(spark, sf_dir, base):
        sent = inputs.damaged_envelopes(stream).withColumnRenamed("timestamp", "sent_at")
        rows = _raw(decode.dedup_stream(sent, "sent_at", "40 days"))
        _drain(
            rows.writeStream.format("parquet").outputMode("append")
            .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start())
    return spark.read.parquet(f"{base}/out")


def _lake_of_parts(spark: SparkSession, sf_dir: str, name: str, files: int) -> str:
    """A lake that four runs on one checkpoint have streamed, with at most so many files a partition and batch; its path."""
    base = shared_dir(spark, name)
    for stream in _in_parts(spark, sf_dir, base):
        _drain(sinks.write_lake(to_lake_rows(inputs.envelopes(stream)), "parquet", f"{base}/out", f"{base}/checkpoint",
                                name, {"availableNow": True}, files=files))
    return f"{base}/out"


def stream_lake_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.partition_counts(read_lake(spark, _lake_of_parts(spark, sf_dir, "lake-parts", files=2), "parquet"))


def _timed(stream: DataFrame) -> DataFrame:
    """Times as instants, which a watermark needs."""
    return stream.withColumn("ts", instant(F.col("ts")))


def _drained(spark: SparkSession, sf_dir: str, name: str, rows_of) -> DataFrame:
    """What four runs on one checkpoint have appended of `rows_of(stream of events)`."""
    base = shared_dir(spark, name)
    for stream in _in_parts(spark, sf_dir, base):
        _drain(
            rows_of(stream).writeStream.format("parquet").outputMode("append")
            .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    return spark.read.parquet(f"{base}/out")


def stream_reported_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows of sends and of delivery reports, two streams that are joined."""
    found = _drained(spark, sf_dir, "reported", lambda stream: _reported(metrics.reported_metrics(
        _timed(inputs.sends(stream)), _timed(inputs.reports(stream)), width=WIDTH, within=REPORTED, watermark="10 seconds")))
    return found.withColumn("window_start", utc_wall(F.col("window_start")))


def _rate_samples(stream: DataFrame) -> DataFrame:
    """A sample of each gauge per delivery, as a client's registry would be read."""
    sent = inputs.deliveries(stream)
    value = F.col("planned_delay")
    return metrics.to_samples(
        sent.select("ts", "topic", "client_id", value.alias("rate"), F.lit(0).alias("dropped_count"), value.alias("error_rate"), value.alias("avg_delay")),
        at="ts")


def session_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zero for each time that a client has stopped."""
    return _flat(metrics.stop_samples(_rate_samples(inputs.events(spark, sf_dir)), gap=STOPPED))


def stream_stop_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a stream, once it is certain."""
    found = _drained(spark, sf_dir, "zeros", lambda stream: metrics.stop_samples(
        _timed(_rate_samples(stream)), gap=STOPPED, watermark="10 seconds"))
    return _flat(found).withColumn("ts", utc_wall(F.col("ts")))


def stream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean gap and elapsed time of the windows that four runs have closed."""
    base = shared_dir(spark, "gaps")
    for stream in _in_parts(spark, sf_dir, base):
        _drain(carried.write_gaps(
            _timed(inputs.deliveries(stream)), f"{base}/out", f"{base}/checkpoint", "gaps", width=WIDTH, trigger={"availableNow": True}))
    return spark.read.parquet(f"{base}/out").select(
        "topic", utc_wall(F.col("window_start")).alias("window_start"), "n", "avg_delay", "elapsed_seconds")


def stream_lambda_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of newest control values that four runs have kept up."""
    base = shared_dir(spark, "lambda")
    for stream in _in_parts(spark, sf_dir, base):
        _drain(sinks.upsert_lambda(
            metrics.newest_lambda(inputs.controls(stream)), f"{base}/out", f"{base}/checkpoint", "lambda", {"availableNow": True}))
    return sinks.read_lambda(spark, f"{base}/out")


def stream_metrics_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV log of the windows that four runs have closed."""
    base = shared_dir(spark, "metrics-stream")
    for stream in _in_parts(spark, sf_dir, base):
        closed = metrics.producer_metrics(_timed(inputs.deliveries(stream)), ["topic"], WIDTH, watermark="10 seconds")
        _drain(sinks.stream_metrics_csv(closed, f"{base}/log", f"{base}/checkpoint", "1", {"availableNow": True}, WIDTH))
    return read_metrics_csv(spark, f"{base}/log").drop("batch")


def metrics_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "metrics-log")
    log = metrics.with_elapsed(_metrics(spark, sf_dir, keys=["topic"]))
    sinks.write_metrics_csv(log, base, "1")
    return read_metrics_csv(spark, base).drop("batch")
