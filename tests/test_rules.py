import pytest
from conftest import rows

from iotlake.operators import rules
from iotlake.operators.rules import BROKER_RULES, COORDINATION_RULES, FIRST_MATCH, MOST_SPECIFIC

LEADER = "org.apache.ZooKeeperService<name0=ReplicatedServer_id1,name1=replica.1,name2=Leader>:"

# Source name; rule, name and labels of the first match; the same of the most specific one.
SHADOWED = {
    "kafka.server<type=ReplicaManager, name=LeaderCount><>Value": (
        (1, "kafka_server_replicamanager_leadercount", {}),) * 2,
    "kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec, topic=topic-json><>Value": (
        (1, "kafka_server_brokertopicmetrics_messagesinpersec_topic_topic_json", {}),
        (14, "kafka_broker_topic_metrics_messagesinpersec", {"topic": "topic-json"})),
    "kafka.server<type=Fetcher, name=BytesPerSec, topic=t><>Value": (
        (1, "kafka_server_fetcher_bytespersec_topic_t", {}),
        (2, "kafka_server_fetcher_bytespersec", {"topic": "t"})),
    "kafka.server<type=Produce, name=ByteRate, client-id=p1><>Value": (
        (1, "kafka_server_produce_byterate_client_id_p1", {}),
        (3, "kafka_server_produce_byterate", {"client_id": "p1"})),
    "kafka.network<type=SocketServer, name=NetworkProcessorAvgIdlePercent><>Value": (
        (4, "kafka_network_socketserver_networkprocessoravgidlepercent", {}),) * 2,
    "kafka.network<type=Processor, name=IdlePercent, networkProcessor=2><>Value": (
        (4, "kafka_network_processor_idlepercent_networkprocessor_2", {}),
        (5, "kafka_network_processor_idlepercent", {"network_processor": "2"})),
    "kafka.request<type=RequestMetrics, name=RequestsPerSec, request=Produce><>Value": (
        (6, "kafka_request_requestspersec", {"request": "Produce"}),) * 2,
    "kafka.controller<type=KafkaController, name=ActiveControllerCount><>Value": (
        (7, "kafka_controller_kafkacontroller_activecontrollercount", {}),) * 2,
    "kafka.log<type=Log, name=Size, topic=topic-json, partition=0><>Value": (
        (8, "kafka_log_log_size", {"topic": "topic-json", "partition": "0"}),) * 2,
    "kafka.log<type=Log, name=Size, topic=topic-json><>Value": (
        (9, "kafka_log_log_size", {"topic": "topic-json"}),) * 2,
    "kafka.cluster<type=Partition, name=UnderReplicated><>Value": (
        (10, "kafka_cluster_partition_underreplicated", {}),) * 2,
    "kafka.coordinator<type=GroupMetadataManager, name=NumGroups><>Value": (
        (11, "kafka_coordinator_groupmetadatamanager_numgroups", {}),) * 2,
    "kafka.replica<type=Replica, name=Lag, topic=topic-parq, partition=1><>Value": (
        (12, "kafka_replica_replica_lag", {"topic": "topic-parq", "partition": "1"}),) * 2,
    "kafka.server<type=FetcherLagMetrics, client-id=c1, topic=t, partition=3, name=ConsumerLag><>Value": (
        (1, "kafka_server_fetcherlagmetrics_client_id_c1_topic_t_partition_3_consumerlag", {}),
        (13, "kafka_fetcher_lag_metrics_consumerlag", {"client_id": "c1", "topic": "t", "partition": "3"})),
    "kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec><>Value": (
        (1, "kafka_server_brokertopicmetrics_bytesinpersec", {}),
        (15, "kafka_broker_topic_metrics_bytesinpersec", {})),
    "java.lang<type=Memory><>HeapMemoryUsage": ((16, "jvm_memory_heapmemoryusage", {}),) * 2,
    "java.lang<type=GarbageCollector, name=G1 Old Generation><>CollectionCount": (
        (17, "jvm_gc_collection_count", {"gc_collector": "G1 Old Generation"}),) * 2,
    "java.lang<type=GarbageCollector, name=G1 Old Generation><>CollectionTime": (
        (18, "jvm_gc_collection_time", {"gc_collector": "G1 Old Generation"}),) * 2,
    "java.lang<type=Threading><>ThreadCount": ((19, "jvm_thread_threadcount", {}),) * 2,
    "java.lang<type=OperatingSystem><>OpenFileDescriptorCount": ((20, "jvm_os_openfiledescriptorcount", {}),) * 2,
    "prefix java.lang<type=Threading><>ThreadCount": ((19, "jvm_thread_threadcount", {}),) * 2,
}


def apply(spark, names, chosen, how, mode=FIRST_MATCH, **options):
    frame = spark.createDataFrame([(n, n) for n in names], "source string, name string")
    result = how(frame, chosen, mode, **options)
    return {r.source: (r.rule, r["name"], r.labels) for r in result.collect()}


@pytest.mark.parametrize("how", [rules.normalize_names])
@pytest.mark.parametrize("mode,position", [(FIRST_MATCH, 0), (MOST_SPECIFIC, 1)])
def test_broker_rules(spark, how, mode, position):
    names = [*SHADOWED, "kafka.other<type=X>", "", None]
    assert apply(spark, names, BROKER_RULES, how, mode) == {k: v[position] for k, v in SHADOWED.items()}


def test_every_rule_fires_in_one_of_the_orders():
    fired = {result[0] for case in SHADOWED.values() for result in case}
    assert set(range(1, 21)) == fired


def test_types_and_help(spark):
    frame = spark.createDataFrame([(n,) for n in SHADOWED], "name string")
    result = {r.rule: r for r in rules.normalize_names(frame, BROKER_RULES).collect()}
    assert {n for n, r in result.items() if r.type == "COUNTER"} == {17, 18}
    assert result[8].help == "Kafka log metric Log Size per topic/partition"
    assert result[16].help == "JVM memory usage"
    assert result[17].help is None


@pytest.mark.parametrize("how", [rules.normalize_names])
def test_coordination_rules_keep_every_other_name(spark, how):
    names = [LEADER + n for n in ("AvgRequestLatency", "MaxRequestLatency", "OutstandingRequests", "NumAliveConnections",
                                  "WatchCount", "DataTreeSize", "Other")]
    expected = ["zookeeper_avg_request_latency", "zookeeper_max_request_latency", "zookeeper_outstanding_requests",
                "zookeeper_num_alive_connections", "zookeeper_watch_count", "zookeeper_data_tree_size",
                (LEADER + "Other").lower()]
    result = apply(spark, names, COORDINATION_RULES, how)
    assert [result[n] for n in names] == [(i, e, {}) for i, e in enumerate(expected, start=1)]


def test_case_is_kept_on_request(spark):
    own = (rules.Rule("a<(.+)>", "Name_$1", {"Topic": "$1"}),)
    assert apply(spark, ["a<X>"], own, rules.normalize_names, lower=False) == {"a<X>": (1, "Name_X", {"Topic": "X"})}
    assert apply(spark, ["a<X>"], own, rules.normalize_names) == {"a<X>": (1, "name_x", {"topic": "X"})}


def test_names_become_legal(spark):
    own = (rules.Rule("(.*)", "$1"),)
    assert apply(spark, ["9 lives--x__y"], own, rules.normalize_names) == {"9 lives--x__y": (1, "_9_lives_x_y", {})}


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        rules.normalize_names(spark.createDataFrame([("x",)], "name string"), BROKER_RULES, "last_match")


def test_sample_columns_are_kept(spark):
    frame = spark.createDataFrame([("java.lang<type=Threading><>ThreadCount", 4.0)], "name string, value double")
    assert rows(rules.normalize_names(frame, BROKER_RULES), "value", "name") == [(4.0, "jvm_thread_threadcount")]
