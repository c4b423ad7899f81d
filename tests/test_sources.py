from datetime import datetime, timedelta, timezone

import pytest

from iotlake import session as sessions
from iotlake.plans import jobs
from iotlake.scratch import shared_dir
from iotlake.sources import topic
from iotlake.sources.lake import _utc


class Reader:
    """Records what a reader is told."""

    def __init__(self):
        self.kind, self.told = None, {}

    def format(self, kind):
        self.kind = kind
        return self

    def options(self, **options):
        self.told = options
        return self

    def load(self):
        return self


class Session:
    def __init__(self):
        self.readStream, self.read = Reader(), Reader()


def test_stream_without_start_leaves_it_to_the_connector():
    reader = topic.read_topic(Session(), "kafka:29092", "topic-json", "spark-consumer-json", client=jobs.LAKE_CLIENT)
    assert reader.kind == "kafka"
    assert reader.told == {
        "kafka.bootstrap.servers": "kafka:29092", "subscribe": "topic-json",
        "kafka.group.id": "spark-consumer-json",
        "kafka.metrics.recording.level": "DEBUG", "kafka.consumer.metrics.enable": "true"}


def test_stream_with_start_and_limits():
    reader = topic.read_topic(Session(), "a:1,b:2", "t", "g", starting="latest", min_partitions=64,
                              max_offsets_per_trigger=1000)
    assert reader.told == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "t", "kafka.group.id": "g",
        "startingOffsets": "latest", "minPartitions": "64", "maxOffsetsPerTrigger": "1000"}


def test_range_is_a_batch():
    spark = Session()
    reader = topic.read_topic_range(spark, "a:1", "t", starting='{"t":{"0":5}}')
    assert reader is spark.read
    assert reader.told["startingOffsets"] == '{"t":{"0":5}}'
    assert reader.told["endingOffsets"] == "latest"


def test_object_store_settings():
    conf = sessions.object_store_conf("http://store:9000", access_key="k", secret_key="s")
    assert conf == {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.endpoint": "http://store:9000",
        "spark.hadoop.fs.s3a.access.key": "k",
        "spark.hadoop.fs.s3a.secret.key": "s"}
    assert not any("key" in name for name in sessions.object_store_conf())
    with pytest.raises(ValueError):
        sessions.object_store_conf(access_key="k")


def test_job_arguments():
    args = jobs._arguments(["json", "--servers", "a:1", "--path", "p", "--checkpoint", "c", "--every", "1 minute"])
    assert (args.zone, args.keys, args.starting) == ("America/Chicago", "lake", None)
    assert jobs._trigger(args) == {"processingTime": "1 minute"}
    assert jobs._trigger(jobs._arguments(["tail", "--servers", "a:1"])) is None
    assert jobs._trigger(jobs._arguments(["tail", "--servers", "a:1", "--once"])) == {"availableNow": True}
    with pytest.raises(SystemExit):
        jobs._arguments(["parquet", "--servers", "a:1"])


class Conf:
    def __init__(self, **values):
        self.values = {name.replace("_", "."): value for name, value in values.items()}

    def get(self, name, default=None):
        return self.values.get(name, default)


class Configured:
    def __init__(self, **values):
        self.conf = Conf(**values)


def test_shared_folder_comes_from_the_session():
    cluster = Configured(spark_checkpoint_dir="/shared/folder/", spark_master="yarn")
    one, two = shared_dir(cluster, "x"), shared_dir(cluster, "x")
    assert one.startswith("/shared/folder/x-") and one != two


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError):
        shared_dir(Configured(spark_master="spark://host:7077"), "x")
    assert shared_dir(Configured(spark_master="local[2]"), "x")


def test_range_bounds_are_utc():
    moment = datetime(2025, 1, 1, 1, 0, tzinfo=timezone(timedelta(hours=2)))
    assert _utc(moment) == datetime(2024, 12, 31, 23, 0)
    assert _utc(datetime(2025, 1, 1)) == datetime(2025, 1, 1)
