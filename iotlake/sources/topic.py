"""Topic reader over Spark's Kafka connector."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def topic_options(
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str | None = None,
    ending: str | None = None,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    client: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Connector options.

    `starting` is `latest`, `earliest` or offsets as JSON; left out, the
    connector's default applies (a new stream starts at `latest`, a batch read at
    `earliest`, and a checkpoint overrides both). `client` holds consumer
    settings without their `kafka.` prefix. `min_partitions` lets a topic with
    few partitions feed many tasks.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    optional = {
        "kafka.group.id": group,
        "startingOffsets": starting,
        "endingOffsets": ending,
        "minPartitions": min_partitions,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
    }
    options.update({k: str(v) for k, v in optional.items() if v is not None})
    options.update({f"kafka.{k}": str(v) for k, v in (client or {}).items()})
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, group: str | None = None,
               **options) -> DataFrame:
    """Endless stream of envelopes of one topic."""
    return (
        spark.readStream.format("kafka")
        .options(**topic_options(servers, topic, group, **options))
        .load()
    )


def read_topic_range(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                     ending: str = "latest", **options) -> DataFrame:
    """The envelopes between two offsets as a batch, for backfill and checks."""
    return (
        spark.read.format("kafka")
        .options(**topic_options(servers, topic, starting=starting, ending=ending, **options))
        .load()
    )
