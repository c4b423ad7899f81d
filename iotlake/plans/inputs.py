"""Telemetry tables that Spark derives from the `events` table.

`events` has `event_id, ts, user_id, event_type, value, props`; `ts` carries no
zone and is read as UTC. Every row of it yields a message, a delivery and at
least one sample, so the derived tables grow with it.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from iotlake.functions.event_time import instant
from iotlake.functions.labels import label_map
from iotlake.operators.metrics import ERROR_RATE, MESSAGE_RATE

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, because a stream takes a plain path for a folder.
    return spark.readStream.schema(_EVENTS).parquet(f"{sf_dir}/[e]vents.parquet")


def events_stream_of(spark: SparkSession, path: str) -> DataFrame:
    """Folders of event files as a stream; what is there when a batch starts is in it."""
    return spark.readStream.schema(_EVENTS).parquet(f"{path}/*")


def _topic() -> Column:
    return F.when(F.col("user_id") % 2 == 0, "topic-json").otherwise("topic-parq")


def _client() -> Column:
    return F.concat(_topic(), F.lit("-p"), (F.col("user_id") % 4 + 1).cast("string"))


def _payload() -> Column:
    """The device's JSON text."""
    return F.to_json(F.struct(
        F.concat(F.lit("iot_device_"), (F.col("user_id") % 50 + 1).cast("string")).alias("device_id"),
        (F.lit(20) + F.col("event_id") % 81).cast("int").alias("battery_level"),
        (F.col("event_id") % 2 == 0).alias("motion_detected"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
    ))


def envelopes(events: DataFrame, payload: Column | None = None) -> DataFrame:
    """One message per event."""
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        (_payload() if payload is None else payload).cast("binary").alias("value"),
        _topic().alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        instant(F.col("ts")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def damaged_envelopes(events: DataFrame) -> DataFrame:
    """One message per event, damaged in a way that depends on the event's type.

    error: text cut off before its end; signup: plain text; click: a battery
    level sent as text; purchase: an unreadable time; view: as sent.
    """
    good = _payload()
    kind = F.col("event_type")
    payload = (
        F.when(kind == "error", F.substring(good, 1, 30))
        .when(kind == "signup", F.col("event_type"))
        .when(kind == "click", F.regexp_replace(good, r'"battery_level":(\d+)', r'"battery_level":"$1"'))
        .when(kind == "purchase", F.regexp_replace(good, r'"timestamp":"[^"]*"', '"timestamp":"yesterday"'))
        .otherwise(good)
    )
    return envelopes(events, payload)


def odd_time_envelopes(events: DataFrame) -> DataFrame:
    """One message per event, its time written in a way that depends on the event's type."""
    kind = F.col("event_type")
    form = (
        F.when(kind == "error", F.date_format("ts", "yyyy-MM-dd'T'HH"))
        .when(kind == "signup", F.date_format("ts", "HH:mm:ss"))
        .when(kind == "click", F.date_format("ts", "'T'HH:mm"))
        .when(kind == "purchase", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return envelopes(events, F.to_json(F.struct(
        F.concat(F.lit("iot_device_"), (F.col("user_id") % 50 + 1).cast("string")).alias("device_id"), form.alias("timestamp"))))


def resent_envelopes(events: DataFrame) -> DataFrame:
    """All messages, and those of failed deliveries once more, at an offset of their own."""
    again = envelopes(events.where(F.col("event_type") == "error")).withColumn("offset", F.col("offset") + 10 ** 12)
    return envelopes(events).unionByName(again)


def deliveries(events: DataFrame, *keep: str) -> DataFrame:
    """One delivery attempt per event; the planned delay is a multiple of 1/64 s."""
    return events.select(
        *keep,
        "ts",
        _topic().alias("topic"),
        _client().alias("client_id"),
        (F.floor(F.col("value") * 64).cast("double") / 64).alias("planned_delay"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"),
    )


def sends(events: DataFrame) -> DataFrame:
    """One send per event; a full buffer refuses those of signups."""
    status = F.when(F.col("event_type") == "signup", "refused").otherwise("sent")
    return events.select(
        "ts", _topic().alias("topic"), _client().alias("client_id"), F.col("event_id").alias("message_id"),
        (F.floor(F.col("value") * 64).cast("double") / 64).alias("planned_delay"), status.alias("status"))


def reports(events: DataFrame) -> DataFrame:
    """The delivery report of each accepted send, up to two hours after it; every eleventh never comes."""
    told = events.where("event_type <> 'signup' AND event_id % 11 <> 0")
    return told.select(
        F.col("event_id").alias("message_id"),
        (F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 7 * 20).cast("int"))).alias("ts"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"))


def samples(events: DataFrame) -> DataFrame:
    """A message-rate sample per event and an error-rate sample per failed one.

    `impl` is missing except for every third user's client. `event_id` tells
    samples of one instant apart.
    """
    common = [F.lit("topic"), _topic(), F.lit("client_id"), _client()]
    labels = F.when(
        F.col("user_id") % 3 == 0, F.create_map(*common, F.lit("impl"), F.lit("ckafka"))
    ).otherwise(F.create_map(*common))
    failed = F.col("event_type") == "error"
    metrics = F.when(failed, F.array(F.lit(MESSAGE_RATE), F.lit(ERROR_RATE))).otherwise(
        F.array(F.lit(MESSAGE_RATE)))
    return events.select("ts", F.explode(metrics).alias("metric"), labels.alias("labels"), "value", "event_id")


def scraped(events: DataFrame) -> DataFrame:
    """Message-rate samples as scraped: no `impl` yet, but the job and the instance they came from."""
    stack = F.when(F.col("user_id") % 2 == 0, "json").otherwise("parq")
    job = F.concat(
        F.lit("kafka-producer-"), stack, F.when(F.col("user_id") % 3 == 0, "-ckafka").otherwise(""))
    labels = F.create_map(F.lit("topic"), _topic(), F.lit("client_id"), _client())
    port = F.concat(F.lit("91"), F.when(F.col("user_id") % 3 == 0, "1").otherwise("0"), F.when(stack == "json", "8").otherwise("9"))
    return events.select(
        "ts", F.lit(MESSAGE_RATE).alias("metric"), labels.alias("labels"), "value", "event_id", job.alias("job"),
        F.concat(F.lit("host.docker.internal:"), port).alias("instance"))


def one_per_instant(samples: DataFrame) -> DataFrame:
    """A sample per series and instant: its largest."""
    return samples.groupBy("ts", "metric", "labels").agg(F.max("value").alias("value"))


def targets(events: DataFrame) -> DataFrame:
    """Labels of each producer job that has some: only the JSON topic's producers."""
    topics = events.select(_topic().alias("topic")).distinct().where("topic = 'topic-json'")
    job = F.concat(F.lit("producer-"), F.col("topic"))
    return topics.select(
        job.alias("job"),
        label_map({"impl": F.lit("kpython"), "job": job}).alias("target_labels"))


def controls(events: DataFrame) -> DataFrame:
    """One control value per event, around zero so that clamping shows."""
    return events.select("ts", _topic().alias("topic"), (F.col("value") - 15).alias("lambda"))


def bean_samples(events: DataFrame) -> DataFrame:
    """Samples under the broker's own metric names, chosen by type and user."""
    kind, topic = F.col("event_type"), _topic()
    partition = (F.col("user_id") % 3).cast("string")
    name = (
        F.when(kind == "view", F.concat(
            F.lit("kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec, topic="), topic, F.lit("><>Value")))
        .when(kind == "click", F.concat(
            F.lit("kafka.log<type=Log, name=LogEndOffset, topic="), topic,
            F.lit(", partition="), partition, F.lit("><>Value")))
        .when(kind == "signup", F.concat(
            F.lit("kafka.server<type=FetcherLagMetrics, client-id="), _client(), F.lit(", topic="), topic,
            F.lit(", partition="), partition, F.lit(", name=ConsumerLag><>Value")))
        .when(kind == "purchase", F.lit("java.lang<type=GarbageCollector, name=G1 Young Generation><>CollectionCount"))
        .otherwise(F.lit("kafka.unknown<type=Other><>Count"))
    )
    return events.select(name.alias("name"), "ts", "value")


def coordination_samples(events: DataFrame) -> DataFrame:
    """Samples under the coordination service's own metric names."""
    kind = F.col("event_type")
    leader = F.concat(
        F.lit("org.apache.ZooKeeperService<name0=ReplicatedServer_id"), (F.col("user_id") % 3).cast("string"),
        F.lit(",name1=replica."), (F.col("user_id") % 5).cast("string"), F.lit(",name2=Leader>:"))
    name = F.concat(leader, (
        F.when(kind == "view", "AvgRequestLatency").when(kind == "click", "OutstandingRequests")
        .when(kind == "signup", "WatchCount").otherwise("ElectionTimeTaken")))
    return events.select(name.alias("name"), "ts", "value")


def every_bean(events: DataFrame) -> DataFrame:
    """A sample per event under a broker's name that is made for one of the rules, by the event's number; every 21st fits none."""
    def named(text: str) -> Column:
        return F.format_string(text.replace("{topic}", "%1$s").replace("{client}", "%2$s").replace("{partition}", "%3$s").replace(
            "{type}", "%4$s"), _topic(), _client(), (F.col("user_id") % 3).cast("string"), F.col("event_type"))

    names = [
        "kafka.server<type=ReplicaManager, name=LeaderCount><>Value",
        "kafka.server<type=Fetcher, name=BytesPerSec, topic={topic}><>Value",
        "kafka.server<type=Produce, name=ByteRate, client-id={client}><>Value",
        "kafka.network<type=SocketServer, name=IdlePercent><>Value",
        "kafka.network<type=Processor, name=IdlePercent, networkProcessor={partition}><>Value",
        "kafka.request<type=RequestMetrics, name=TotalTimeMs, request={type}><>Value",
        "kafka.controller<type=KafkaController, name=ActiveControllerCount><>Value",
        "kafka.log<type=Log, name=LogEndOffset, topic={topic}, partition={partition}><>Value",
        "kafka.log<type=Log, name=Size, topic={topic}><>Value",
        "kafka.cluster<type=Partition, name=UnderReplicated><>Value",
        "kafka.coordinator<type=GroupMetadataManager, name=NumGroups><>Value",
        "kafka.replica<type=Replica, name=Lag, topic={topic}, partition={partition}><>Value",
        "kafka.server<type=FetcherLagMetrics, client-id={client}, topic={topic}, partition={partition}, name=ConsumerLag><>Value",
        "kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec, topic={topic}><>Value",
        "kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec><>Value",
        "java.lang<type=Memory><>HeapMemoryUsage",
        "java.lang<type=GarbageCollector, name=G1 Old Generation><>CollectionCount",
        "java.lang<type=GarbageCollector, name=G1 Old Generation><>CollectionTime",
        "java.lang<type=Threading><>ThreadCount",
        "java.lang<type=OperatingSystem><>OpenFileDescriptorCount",
        "kafka.unknown<type=Other><>Count",
    ]
    name = F.get(F.array(*map(named, names)), (F.col("event_id") % len(names)).cast("int"))
    return events.select(name.alias("name"), "event_id", "value")


def every_coordination_bean(events: DataFrame) -> DataFrame:
    """A sample per event under a name that is made for one of the coordination rules, the last of which keeps it."""
    leader = F.concat(F.lit("org.apache.ZooKeeperService<name0=ReplicatedServer_id"), (F.col("user_id") % 3).cast("string"),
                      F.lit(",name1=replica."), (F.col("user_id") % 5).cast("string"), F.lit(",name2=Leader>:"))
    read = ["AvgRequestLatency", "MaxRequestLatency", "OutstandingRequests", "NumAliveConnections", "WatchCount", "DataTreeSize", "PacketsSent"]
    name = F.concat(leader, F.get(F.array(*map(F.lit, read)), (F.col("event_id") % len(read)).cast("int")))
    return events.select(name.alias("name"), "event_id", "value")
