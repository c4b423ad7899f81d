from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from iotlake.operators import monitor
from iotlake.plans import inputs
from iotlake.plans.report import report, starting_offsets, summaries
from iotlake.sources.lake import read_lake, read_lake_between
from iotlake.streaming.sinks import write_lake_batch


@pytest.fixture
def checkpoint(tmp_path):
    folder = tmp_path / "checkpoint" / "offsets"
    folder.mkdir(parents=True)
    for batch, offsets in enumerate([
        '{"t":{"0":5,"1":7}}', '{"t":{"0":9,"1":7}}', '{"t":{"0":12,"1":8}}', '{"t":{"0":20,"1":8,"10":3}}',
    ], start=8):
        (folder / str(batch)).write_text(f'v1\n{{"batchWatermarkMs":0,"conf":{{}}}}\n{offsets}')
        (folder / f".{batch}.crc").write_bytes(b"x")
    # The newest batch was begun and never finished.
    (tmp_path / "checkpoint" / "commits").mkdir()
    for batch in (8, 9, 10):
        (tmp_path / "checkpoint" / "commits" / str(batch)).write_text('v1\n{"nextBatchWatermarkMs":0}')
    return str(tmp_path / "checkpoint")


def test_committed_offsets_are_those_of_the_newest_finished_batch(spark, checkpoint):
    result = monitor.committed_offsets(spark, checkpoint, "sink")
    assert rows(result) == [("sink", "t", 0, 12, 20), ("sink", "t", 1, 8, 8), ("sink", "t", 10, None, 3)]


def test_nothing_is_committed_before_the_first_commit(spark, tmp_path):
    (tmp_path / "offsets").mkdir()
    (tmp_path / "offsets" / "0").write_text('v1\n{}\n{"t":{"0":5}}')
    assert rows(monitor.committed_offsets(spark, str(tmp_path), "q")) == [("q", "t", 0, None, 5)]


def test_recent_batches_are_whole(spark, tmp_path):
    (tmp_path / "offsets").mkdir()
    for batch in range(3):
        (tmp_path / "offsets" / str(batch)).write_text('v1\n{}\n{"t":{"0":1}}\n{"u":{"0":1}}')
    found = monitor.recent_batches(spark, str(tmp_path), 2)
    assert rows(found, "batch_id", "source", "committed") == [(1, 0, False), (1, 1, False), (2, 0, False), (2, 1, False)]


def test_recent_batches(spark, checkpoint):
    result = monitor.recent_batches(spark, checkpoint)
    assert rows(result, "batch_id", "committed") == [(10, True), (11, False), (9, True)]


def test_lag(spark, checkpoint):
    ends = spark.createDataFrame([("t", 0, 25), ("t", 1, 8), ("t", 2, 4), ("u", 0, 6)],
                                 "topic string, partition int, end_offset bigint")
    result = monitor.consumer_lag(ends, monitor.committed_offsets(spark, checkpoint, "sink"))
    assert rows(result) == [("t", 0, 25, 12, 13), ("t", 1, 8, 8, 0), ("t", 2, 4, 0, 4), ("u", 0, 6, 0, 6)]
    assert result.where("lag < 0").count() == 0


def test_topic_checks(events):
    envelopes = inputs.envelopes(events)
    assert rows(monitor.topics(envelopes)) == [("topic-json",), ("topic-parq",)]
    assert rows(monitor.describe_topics(envelopes)) == [("topic-json", 3), ("topic-parq", 3)]
    ends = monitor.end_offsets(envelopes)
    assert ends.agg(F.max("end_offset")).first()[0] == events.agg(F.max("event_id") + 1).first()[0]


LAKE = [
    ("d1", 50, True, "2025-01-15T03:04:05Z", date(2025, 1, 15), 21),
    ("d2", None, False, "2025-01-15T06:00:00Z", date(2025, 1, 15), 0),
    ("d3", 60, None, "2025-01-16T00:30:00+05:00", date(2025, 1, 16), 13),
    ("d4", 70, True, "2025-01-17T00:00:00Z", date(2025, 1, 17), 18),
    (None, None, None, None, None, None),
]


@pytest.fixture(params=["json", "parquet"])
def lake(spark, tmp_path, request):
    path = str(tmp_path / "lake")
    frame = spark.createDataFrame(
        LAKE, "device_id string, battery_level int, motion_detected boolean, timestamp string, date date, hour int")
    write_lake_batch(frame, request.param, path)
    return path, request.param


def test_read_back(spark, lake):
    assert rows(read_lake(spark, *lake)) == sorted(LAKE, key=repr)
    assert read_lake(spark, *lake).dtypes[1:] == [
        ("battery_level", "int"), ("motion_detected", "boolean"), ("timestamp", "string"),
        ("date", "date"), ("hour", "int")]


def test_one_date_and_hour(spark, lake):
    assert rows(read_lake(spark, *lake, date="2025-01-15", hour=0), "device_id") == [("d2",)]
    assert rows(read_lake(spark, *lake, date=date(2025, 1, 15)), "device_id") == [("d1",), ("d2",)]


def test_event_time_range(spark, lake):
    chosen = lambda a, b: [d for d, in rows(read_lake_between(spark, *lake, a, b), "device_id")]
    assert chosen(datetime(2025, 1, 15, 3, 4, 5), datetime(2025, 1, 15, 6)) == ["d1"]
    assert chosen(datetime(2025, 1, 15, 6), datetime(2025, 1, 15, 20)) == ["d2", "d3"]
    assert chosen(datetime(2025, 1, 16), datetime(2025, 1, 17, 0, 0, 1)) == ["d4"]


def test_counts_add_up(spark, lake):
    counts = monitor.partition_counts(read_lake(spark, *lake))
    assert counts.agg(F.sum("n")).first()[0] == len(LAKE)
    assert (None, None, 1) in rows(counts)


def test_newest_files(spark, lake):
    found = monitor.newest_files(spark, lake[0], n=3).collect()
    assert len(found) == 3
    assert [r.modified for r in found] == sorted((r.modified for r in found), reverse=True)
    assert all("/_" not in r.path and r.size > 0 for r in found)


def test_report(spark, events, lake, checkpoint):
    parts = report(spark, inputs.envelopes(events), {lake[1]: lake[0]}, {"sink": checkpoint})
    assert list(parts) == ["topics", "end offsets", "lag", "newest batches of sink", f"newest {lake[1]} files",
                           f"{lake[1]} rows"]
    # The checkpoint's own two committed partitions are added to the topics' six.
    assert [part.count() for part in parts.values()] == [2, 8, 8, 3, 2, 5]
    assert starting_offsets(spark, {"sink": checkpoint}) == '{"t": {"0": 12, "1": 8}}'
    assert summaries(parts)["lag"].first().total_lag == parts["lag"].agg(F.sum("lag")).first()[0]
