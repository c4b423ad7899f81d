"""Streams: equal to the batch, restartable, and refusing a lost checkpoint."""

import shutil
import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from iotlake.operators import decode, metrics, monitor, series
from iotlake.plans import jobs, queries
from iotlake.schemas import DELIVERY, ENVELOPE, METRICS_LOG
from iotlake.sources.checkpoint import sink_log
from iotlake.sources.lake import read_lake
from iotlake.sources.metrics_log import read_metrics_csv
from iotlake.sources.replay import read_envelopes, replay
from iotlake.streaming import carried, progress, sinks
from iotlake.streaming.recovery import CheckpointMismatch, check_recovery

ONCE = {"availableNow": True}
COLUMNS = ["device_id", "battery_level", "motion_detected", "timestamp", "date", "hour"]


def payload(i, at="2025-01-15T03:04:05Z"):
    return f'{{"device_id":"d{i}","battery_level":{20 + i},"motion_detected":true,"timestamp":"{at}"}}'


def add(spark, folder, payloads, first=0, start="2025-01-15 03:04:05"):
    """Write one file of envelopes into a replay folder."""
    values = [(p, "topic-json", 0, first + i, i) for i, p in enumerate(payloads)]
    frame = spark.createDataFrame(values, "v string, topic string, partition int, offset bigint, i int").select(
        F.lit(None).cast("binary").alias("key"), F.col("v").cast("binary").alias("value"), "topic", "partition", "offset",
        (F.lit(start).cast("timestamp") + F.make_dt_interval(secs=F.col("i"))).alias("timestamp"),
        F.lit(0).alias("timestampType"))
    frame.coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folders(tmp_path):
    return {name: str(tmp_path / name) for name in ("in", "out", "checkpoint", "more")}


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_lake_stream_equals_batch_over_many_small_batches(spark, folders, fmt):
    add(spark, folders["in"], [payload(0), payload(1), "broken"])
    add(spark, folders["in"], [payload(2, "2025-01-15T07:00:00Z"), None, "{}"], 3)
    add(spark, folders["in"], [payload(3, "2020-01-01T00:00:00Z"), payload(4, "no time")], 6)
    source = replay(spark, folders["in"], max_files_per_trigger=1)
    query = jobs.lake_job(source, fmt, folders["out"], folders["checkpoint"], trigger=ONCE)
    assert query.name == jobs.LAKE_JOBS[fmt][2]
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3

    batch = jobs.lake_rows(read_envelopes(spark, folders["in"]))
    stored = read_lake(spark, folders["out"], fmt)
    assert rows(stored, *COLUMNS) == rows(batch, *COLUMNS)
    assert stored.count() == 8
    counts = dict(((d, h), n) for d, h, n in rows(monitor.partition_counts(stored)))
    assert sum(counts.values()) == 8 and counts[None, None] == 4


def test_files_per_partition_are_bounded_and_a_hot_one_is_split(spark, settings, folders):
    for i in range(8):
        add(spark, folders["in"], [payload(100 * i + j) for j in range(100)] + ["bad"] * 50, 200 * i)
    source = replay(spark, folders["in"]).repartition(8)
    with settings({"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        jobs.lake_job(
            source, "parquet", folders["out"], folders["checkpoint"], trigger=ONCE, files=8).awaitTermination()
    stored = read_lake(spark, folders["out"], "parquet")
    files = stored.groupBy("date").agg(F.count_distinct("_metadata.file_path").alias("files"), F.count("*").alias("n"))
    (bad, bad_files), (good, good_files) = rows(files, "n", "files")
    assert (bad, good) == (400, 800)
    assert 2 <= bad_files <= 4 and 2 <= good_files <= 4


def test_rates_come_from_progress(spark, folders):
    add(spark, folders["in"], [payload(i) for i in range(5)])
    log = progress.ProgressLog()
    spark.streams.addListener(log)
    try:
        query = jobs.lake_job(
            replay(spark, folders["in"]), "parquet", folders["out"], folders["checkpoint"], trigger=ONCE)
        query.awaitTermination()
        rates = progress.progress_rates(spark, [query])
        assert rates.columns == ["name", "batchId", "numInputRows", "inputRowsPerSecond", "processedRowsPerSecond"]
        assert rates.agg(F.sum("numInputRows")).first()[0] == 5
        for _ in range(50):
            if log.rates(spark).count():
                break
            time.sleep(0.1)
        assert log.rates(spark).where("name = 'topic-parq_sink'").agg(F.sum("numInputRows")).first()[0] == 5
        log.save(spark, folders["out"] + "-log")
        assert spark.read.parquet(folders["out"] + "-log").agg(F.sum("numInputRows")).first()[0] >= 5
        assert log.rates(spark).count() == 0
    finally:
        spark.streams.removeListener(log)


class Report:
    """The part of a topic query's newest progress report that holds offsets."""

    def __init__(self, name, *sources):
        self.name, self.sources, self.lastProgress = name, sources, self


class Source:
    def __init__(self, latest, end):
        self.latestOffset, self.endOffset = latest, end


def test_lag_of_a_running_query_comes_from_its_report(spark):
    sink = Report("sink", Source('{"t":{"0":25,"1":8,"2":4}}', '{"t":{"0":20,"1":8}}'))
    files = Report("files", Source(None, '{"logOffset":3}'))
    offsets = progress.progress_offsets(spark, [sink, files])
    assert rows(offsets) == [("sink", "t", 0, 25, 20), ("sink", "t", 1, 8, 8), ("sink", "t", 2, 4, None)]
    ends = offsets.select("topic", "partition", "end_offset")
    assert rows(monitor.consumer_lag(ends, offsets), "partition", "lag") == [(0, 5), (1, 0), (2, 4)]


def test_restart_neither_loses_nor_repeats(spark, folders):
    run = lambda: jobs.lake_job(
        replay(spark, folders["in"]), "parquet", folders["out"], folders["checkpoint"], trigger=ONCE).awaitTermination()
    add(spark, folders["in"], [payload(0), payload(1)])
    run()
    run()
    add(spark, folders["in"], [payload(2)], 2)
    run()
    assert [d for d, in rows(read_lake(spark, folders["out"], "parquet"), "device_id")] == ["d0", "d1", "d2"]


def test_lost_checkpoint_is_refused(spark, folders):
    start = lambda checkpoint, out: jobs.lake_job(replay(spark, folders["in"]), "parquet", out, checkpoint, trigger=ONCE)
    add(spark, folders["in"], [payload(0)])
    start(folders["checkpoint"], folders["out"]).awaitTermination()
    add(spark, folders["in"], [payload(1)], 1)
    with pytest.raises(CheckpointMismatch):
        start(folders["checkpoint"] + "-new", folders["out"])
    start(folders["checkpoint"], folders["out"]).awaitTermination()
    assert read_lake(spark, folders["out"], "parquet").count() == 2

    shutil.copytree(folders["checkpoint"], folders["more"])
    Path(folders["more"], "offsets", "1").unlink()
    with pytest.raises(CheckpointMismatch):
        check_recovery(spark, folders["out"], folders["more"])


def test_new_sink_passes_the_check(spark, folders):
    check_recovery(spark, folders["out"], folders["checkpoint"])


def test_tail_goes_to_the_console_untruncated(spark, folders):
    add(spark, folders["in"], ["a payload that is longer than twenty characters"])
    query = jobs.tail_job(replay(spark, folders["in"]), ONCE)
    query.awaitTermination()
    reports = query.recentProgress
    assert sum(p.numInputRows for p in reports) == 1
    assert "ConsoleTable" in reports[0].sink.description


def deliveries(spark, folder, n=60):
    start = datetime(2025, 1, 1, 12)
    sent = [(start + timedelta(seconds=i), f"topic-{i % 2}", f"c{i % 4}", i % 8 / 8, "error" if i % 5 == 0 else "ok")
            for i in range(n)]
    for i in range(0, n, 20):
        spark.createDataFrame(sent[i:i + 20], DELIVERY).withColumn(
            "ts", F.convert_timezone(F.lit("UTC"), F.current_timezone(), "ts").cast("timestamp")
        ).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


def drain(frame, folders, mode="append"):
    frame.writeStream.format("parquet").outputMode(mode).option("path", folders["out"]).option(
        "checkpointLocation", folders["checkpoint"]).trigger(**ONCE).start().awaitTermination()
    return frame.sparkSession.read.schema(frame.schema).parquet(folders["out"])


@pytest.fixture
def sent(spark, folders):
    batch = deliveries(spark, folders["in"])
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(folders["in"])
    return batch, stream


def closed(frame, column, folders, delay):
    last = frame.sparkSession.read.parquet(folders["in"]).agg(F.max("ts")).first()[0]
    return frame.where(F.col(column) <= F.lit(last - timedelta(seconds=delay)))


def test_metrics_stream_equals_batch_for_closed_windows(sent, folders):
    batch, stream = sent
    expected = closed(metrics.producer_metrics(batch), "window_end", folders, 5)
    actual = drain(metrics.producer_metrics(stream, watermark="5 seconds"), folders)
    assert rows(actual.drop("window")) == rows(expected.drop("window"))
    assert len(rows(actual)) == 20


def test_metrics_survive_a_restart(spark, folders):
    """Windows that were open at the stop are closed by the next run with nothing lost or counted twice."""
    batch = deliveries(spark, folders["in"])
    files = sorted(Path(folders["in"]).glob("*.parquet"), key=lambda f: spark.read.parquet(str(f)).first()["ts"])
    Path(folders["more"]).mkdir()
    for file in files:
        shutil.copy(file, folders["more"])
        stream = spark.readStream.schema(batch.schema).parquet(folders["more"])
        actual = drain(metrics.producer_metrics(stream, watermark="5 seconds"), folders)
    expected = closed(metrics.producer_metrics(batch), "window_end", folders, 5)
    assert rows(actual.drop("window")) == rows(expected.drop("window"))


def test_late_messages_are_left_out_of_stream_metrics(spark, sent, folders):
    batch, _ = sent
    stream = spark.readStream.schema(batch.schema).parquet(folders["in"])

    def count():
        written = drain(metrics.producer_metrics(stream, watermark="5 seconds"), folders)
        return written.agg(F.sum("msg_count")).first()[0]

    before = count()
    first = batch.agg(F.min("ts")).first()[0]
    batch.where(F.col("ts") == first).coalesce(1).write.mode("append").parquet(folders["in"])
    assert count() == before == 50


def test_metrics_to_panel_in_one_stream(sent, folders):
    """Window metrics, samples, one sample per step, sum per topic: chained."""
    batch, stream = sent

    def panel(frame, **options):
        samples = metrics.to_samples(metrics.producer_metrics(frame, **options), at="window")
        stepped = series.per_step(series.select_series(samples, metrics.MESSAGE_RATE), "20 seconds")
        return series.sum_by(stepped, "topic", scale=6)

    actual = rows(drain(panel(stream, watermark="1 second"), folders))
    expected = rows(panel(batch))
    assert actual and set(actual) <= set(expected)
    assert len(actual) >= len(expected) - 4


def test_sampling_stream_equals_batch(spark, sent, folders):
    batch, stream = sent
    as_samples = lambda frame: frame.select(
        "ts", F.lit("m").alias("metric"), F.create_map(F.lit("topic"), F.col("topic")).alias("labels"),
        F.col("planned_delay").alias("value"))
    expected = series.per_step(as_samples(batch), "10 seconds").select("step", F.col("labels")["topic"], "value")
    actual = drain(series.per_step(as_samples(stream), "10 seconds", watermark="1 second").select(
        "step", F.col("labels")["topic"].alias("topic"), "value"), folders)
    assert set(rows(actual)) <= set(rows(expected))
    assert len(rows(actual)) == 10


@pytest.fixture
def parts(spark, folders):
    """All deliveries, and a stream whose files come one before each step."""
    batch = deliveries(spark, folders["in"])
    files = sorted(Path(folders["in"]).glob("*.parquet"), key=lambda f: spark.read.parquet(str(f)).first()["ts"])
    Path(folders["more"]).mkdir()

    def steps():
        for file in files:
            shutil.copy(file, folders["more"])
            yield spark.readStream.schema(batch.schema).parquet(folders["more"])

    return batch, steps()


def undo_last(folders):
    """As if the last batch had failed before it was committed: the next start runs it again."""
    last = max(int(p.name) for p in Path(folders["checkpoint"], "commits").iterdir() if p.name.isdigit())
    Path(folders["checkpoint"], "commits", str(last)).unlink()
    Path(folders["checkpoint"], "commits", f".{last}.crc").unlink(missing_ok=True)


def test_metrics_log_of_a_stream(spark, parts, folders):
    batch, steps = parts
    for stream in steps:
        windows = metrics.producer_metrics(stream, ["topic"], watermark="5 seconds")
        start = lambda: sinks.stream_metrics_csv(windows, folders["out"], folders["checkpoint"], "7", ONCE).awaitTermination()
        start()
        undo_last(folders)
        start()
    expected = closed(metrics.with_elapsed(metrics.producer_metrics(batch, ["topic"])), "window_end", folders, 5)
    log = read_metrics_csv(spark, folders["out"]).where("run = '7'")
    assert rows(log, *sinks.metrics_log(expected).columns) == rows(sinks.metrics_log(expected))
    assert log.select("batch").distinct().count() > 1
    with pytest.raises(CheckpointMismatch):
        sinks.stream_metrics_csv(windows, folders["out"], folders["checkpoint"] + "-new", "7", ONCE)


@pytest.mark.parametrize("repeat", [False, True])
def test_gaps_of_a_stream_equal_the_batch(spark, parts, folders, repeat):
    batch, steps = parts
    for stream in steps:
        start = lambda: carried.write_gaps(
            stream, folders["out"], folders["checkpoint"], "gaps", ["topic"], "10 seconds", "5 seconds", ONCE).awaitTermination()
        start()
        if repeat:
            undo_last(folders)
            start()
    found = spark.read.parquet(folders["out"])
    expected = metrics.observed_gap(batch, ["topic"], "10 seconds").withColumn("window_end", F.expr("window_start + INTERVAL 10 SECONDS"))
    expected = closed(expected, "window_end", folders, 5)
    assert rows(found, "topic", "window_start", "n", "avg_delay") == rows(expected, "topic", "window_start", "n", "avg_delay")
    first = {r.topic: r.first for r in batch.groupBy("topic").agg(F.min("ts").alias("first")).collect()}
    assert all(r.elapsed_seconds == (r.window_end - first[r.topic]).total_seconds() for r in found.collect())


def test_windows_of_a_missing_key_are_carried(spark, parts, folders):
    batch, steps = parts
    for stream in steps:
        gone = stream.withColumn("topic", F.when(F.col("topic") == "topic-1", F.col("topic")))
        carried.write_gaps(gone, folders["out"], folders["checkpoint"], "gaps", trigger=ONCE, watermark="1 second").awaitTermination()
    found = spark.read.parquet(folders["out"])
    assert {r.topic for r in found.collect()} == {None, "topic-1"}
    assert found.where("previous IS NULL").count() == 2


def test_newest_lambda_of_a_stream(spark, folders):
    def put(*values):
        spark.createDataFrame(values, "second int, topic string, lambda double").select(
            F.timestamp_seconds("second").alias("ts"), "topic", "lambda").coalesce(1).write.mode("append").parquet(folders["in"])
        stream = spark.readStream.schema("ts timestamp, topic string, lambda double").parquet(folders["in"])
        start = lambda: sinks.upsert_lambda(
            metrics.newest_lambda(stream), folders["out"], folders["checkpoint"], "lambda", ONCE).awaitTermination()
        start()
        undo_last(folders)
        start()
        return rows(sinks.read_lambda(spark, folders["out"]))

    assert rows(sinks.read_lambda(spark, folders["out"])) == []
    assert put((10, "a", 5.0), (5, "a", 7.0), (9, "b", 1.0)) == [("a", 5.0), ("b", 1.0)]
    assert put((8, "a", 99.0), (3, "c", -4.0), (9, "b", None)) == [("a", 5.0), ("b", 1.0), ("c", 0.0)]
    assert put((11, "a", 6.0)) == [("a", 6.0), ("b", 1.0), ("c", 0.0)]
    assert sorted(p.name for p in Path(folders["out"]).iterdir()) == ["batch=1", "batch=2"]
    with pytest.raises(CheckpointMismatch):
        sinks.upsert_lambda(metrics.newest_lambda(spark.readStream.schema("ts timestamp, topic string, lambda double").parquet(folders["in"])),
                            folders["out"], folders["more"], "lambda", ONCE)


def test_a_stream_gives_a_zero_once_a_client_has_stopped(spark, folders):
    def put(*seconds):
        spark.createDataFrame([(s, c) for s, c in seconds], "second int, c string").select(
            F.timestamp_seconds("second").alias("ts"), F.lit(metrics.MESSAGE_RATE).alias("metric"),
            F.create_map(F.lit("client_id"), "c").alias("labels"), F.lit(1.0).alias("value")).coalesce(1).write.mode("append").parquet(folders["in"])
        stream = spark.readStream.schema("ts timestamp, metric string, labels map<string,string>, value double").parquet(folders["in"])
        zeros = metrics.stop_samples(stream, gap="10 seconds", watermark="1 second")
        return sorted((r.labels["client_id"], int(r.ts.timestamp())) for r in drain(zeros, folders).collect())

    assert put((0, "a"), (5, "a"), (5, "b")) == []
    assert put((13, "a")) == []
    assert put((22, "a"), (20, "c")) == [("b", 7)]
    assert put((60, "c")) == [("a", 24), ("b", 7), ("c", 22)]


def test_reports_of_a_stream_equal_the_batch(spark, folders):
    """An error that is told two windows later, over two runs."""
    sends = "second int, topic string, client_id string, message_id long, planned_delay double, status string"
    found = None
    for number, (sent, told) in enumerate([
        ([(0, "t", "c", 1, 1.0, "sent"), (3, "t", "c", 2, 2.0, "refused"), (9, "t", "c", 3, 3.0, "sent")], [(1, 4, "ok")]),
        ([(31, "t", "c", 4, 1.0, "sent"), (33, "t", "c", 5, 1.0, "sent")], [(3, 24, "error"), (2, 24, "error"), (4, 32, "error")]),
        ([(300, "t", "c", 6, 1.0, "sent")], [(6, 300, "error"), (5, 299, "error")]),
    ]):
        timed = lambda frame: frame.withColumn("ts", F.timestamp_seconds("second"))
        for name, values, schema in (("s", sent, sends), ("r", told, "message_id long, second int, status string")):
            timed(spark.createDataFrame(values, schema)).coalesce(1).write.mode("append").parquet(f"{folders['in']}/{name}")
        read = lambda how, name: how.schema(spark.read.parquet(f"{folders['in']}/{name}").schema).parquet(f"{folders['in']}/{name}")
        both = lambda how, mark: metrics.reported_metrics(read(how, "s"), read(how, "r"), within="1 minute", watermark=mark)
        found = drain(both(spark.readStream, "1 second").drop("window"), folders)
    batch = both(spark.read, None).drop("window").where("window_start < timestamp_seconds(200)")
    assert rows(found) == rows(batch)
    assert [(r.msg_count, r.error_count) for r in batch.orderBy("window_start").collect()] == [(2, 0), (0, 1), (2, 1)]


def test_sends_that_a_stream_never_hears_of(spark, folders):
    def put(sent, told):
        for name, values in (("s", sent), ("r", told)):
            spark.createDataFrame(values, "message_id long, second int, status string").withColumn(
                "ts", F.timestamp_seconds("second")).coalesce(1).write.mode("append").parquet(f"{folders['in']}/{name}")
        read = lambda name: spark.readStream.schema("message_id long, second int, status string, ts timestamp").parquet(f"{folders['in']}/{name}")
        return rows(drain(metrics.unreported(read("s"), read("r"), "10 seconds", "1 second"), folders), "message_id")

    assert put([(1, 0, "sent"), (2, 1, "sent"), (3, 2, "refused")], [(1, 5, "ok")]) == []
    assert put([(4, 50, "sent")], [(4, 50, "error")]) == [(2,)]


def test_sink_log_names_what_was_committed(spark, settings, folders):
    with settings({"spark.sql.streaming.fileSink.log.compactInterval": "3"}):
        for i in range(5):
            add(spark, folders["in"], [payload(i)], i, f"2025-01-15 0{i}:00:00")
            jobs.lake_job(replay(spark, folders["in"]), "json", folders["out"], folders["checkpoint"], trigger=ONCE).awaitTermination()
    assert any(p.name.endswith(".compact") for p in Path(folders["out"], "_spark_metadata").iterdir())
    stray = Path(folders["out"], "date=2025-01-15", "hour=21", "part-stray.json")
    stray.write_text(payload(9))
    log = sink_log(spark, folders["out"])
    written = {p.name for p in Path(folders["out"]).rglob("part-*.json")} - {stray.name}
    assert {r.path.rsplit("/", 1)[1] for r in log.collect()} == written and log.count() == 5
    newest = monitor.newest_files(spark, folders["out"], 2).collect()
    assert [r.path for r in newest] == [r.path for r in log.orderBy(F.desc("modified")).limit(2).collect()]
    assert all(r.size > 0 for r in newest)
    assert sink_log(spark, folders["more"]).count() == 0


def test_metrics_log_of_a_batch(spark, sent, folders):
    batch, _ = sent
    windows = metrics.with_elapsed(metrics.producer_metrics(batch, ["topic"]))
    for run in ("1", "2"):
        sinks.write_metrics_csv(windows, folders["out"], run)
    log = read_metrics_csv(spark, folders["out"])
    assert log.columns == [*METRICS_LOG.fieldNames(), "run", "batch", "topic"]
    assert rows(log.where("run = '1'").drop("run")) == rows(log.where("run = '2'").drop("run"))
    assert rows(log.where("run = '1'"), *sinks.metrics_log(windows).columns) == rows(sinks.metrics_log(windows))


def test_progress_that_may_be_cut_is_refused(spark, settings):
    class Query:
        name, recentProgress = "q", [None] * 3

    with settings({"spark.sql.streaming.numRecentProgressUpdates": "3"}), pytest.raises(ValueError):
        progress.progress_rates(spark, [Query()])


@pytest.mark.parametrize("salts", [1, 16])
def test_dedup_stream(spark, folders, salts):
    hot = [payload(0)] * 40
    add(spark, folders["in"], hot + [payload(1), "bad"])
    add(spark, folders["in"], hot + [payload(1), payload(2), "bad", "worse"], 42)
    add(spark, folders["in"], hot, 84)
    source = replay(spark, folders["in"], max_files_per_trigger=1).withColumnRenamed("timestamp", "sent_at")
    unique = decode.decode(decode.dedup_stream(source, "sent_at", "1 hour", salts=salts))
    assert [d for d, in rows(drain(unique.select("device_id"), folders))] == ["d0", "d1", "d2", None, None]


def test_replayed_envelopes_have_the_connector_columns(spark, folders):
    add(spark, folders["in"], [payload(0)])
    assert read_envelopes(spark, folders["in"]).schema == ENVELOPE
    assert replay(spark, folders["in"]).schema == ENVELOPE


def test_progress_rates_count_both_runs(spark, events):
    assert [tuple(r) for r in queries.progress_rates(spark, SF).collect()] == [("progress", events.count())]
