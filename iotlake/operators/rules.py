"""Metric-name normalisation by ordered regex rules."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    pattern: str
    name: str | None = None
    labels: dict[str, str] = {}
    type: str | None = None
    help: str | None = None


# Broker rules, in the order they are tried.
BROKER_RULES = (
    Rule("kafka.server<type=(.+), name=(.+)><>Value", "kafka_server_$1_$2", {}, "GAUGE",
         "Kafka server metric $1 $2"),
    Rule("kafka.server<type=(.+), name=(.+), topic=(.+)><>Value", "kafka_server_$1_$2",
         {"topic": "$3"}, "GAUGE", "Kafka server metric $1 $2 per topic"),
    Rule("kafka.server<type=(.+), name=(.+), client-id=(.+)><>Value", "kafka_server_$1_$2",
         {"client_id": "$3"}, "GAUGE", "Kafka server metric $1 $2 per client ID"),
    Rule("kafka.network<type=(.+), name=(.+)><>Value", "kafka_network_$1_$2", {}, "GAUGE",
         "Kafka network metric $1 $2"),
    Rule("kafka.network<type=(.+), name=(.+), networkProcessor=(.+)><>Value", "kafka_network_$1_$2",
         {"network_processor": "$3"}, "GAUGE", "Kafka network metric $1 $2 per processor"),
    Rule("kafka.request<type=RequestMetrics, name=(.+), request=(.+)><>Value", "kafka_request_$1",
         {"request": "$2"}, "GAUGE", "Kafka request metric $1 per request type"),
    Rule("kafka.controller<type=(.+), name=(.+)><>Value", "kafka_controller_$1_$2", {}, "GAUGE",
         "Kafka controller metric $1 $2"),
    Rule("kafka.log<type=(.+), name=(.+), topic=(.+), partition=(.+)><>Value", "kafka_log_$1_$2",
         {"topic": "$3", "partition": "$4"}, "GAUGE", "Kafka log metric $1 $2 per topic/partition"),
    Rule("kafka.log<type=(.+), name=(.+), topic=(.+)><>Value", "kafka_log_$1_$2",
         {"topic": "$3"}, "GAUGE", "Kafka log metric $1 $2 per topic"),
    Rule("kafka.cluster<type=(.+), name=(.+)><>Value", "kafka_cluster_$1_$2", {}, "GAUGE",
         "Kafka cluster metric $1 $2"),
    Rule("kafka.coordinator<type=(.+), name=(.+)><>Value", "kafka_coordinator_$1_$2", {}, "GAUGE",
         "Kafka coordinator metric $1 $2"),
    Rule("kafka.replica<type=(.+), name=(.+), topic=(.+), partition=(.+)><>Value", "kafka_replica_$1_$2",
         {"topic": "$3", "partition": "$4"}, "GAUGE", "Kafka replica metric $1 $2 per topic/partition"),
    Rule("kafka.server<type=FetcherLagMetrics, client-id=(.+), topic=(.+), partition=(.+), name=(.+)><>Value",
         "kafka_fetcher_lag_metrics_$4", {"client_id": "$1", "topic": "$2", "partition": "$3"}, "GAUGE",
         "Kafka fetcher lag metric $4 per topic/partition/client"),
    Rule("kafka.server<type=BrokerTopicMetrics, name=(.+), topic=(.+)><>Value",
         "kafka_broker_topic_metrics_$1", {"topic": "$2"}, "GAUGE",
         "Kafka broker topic metrics $1 per topic"),
    Rule("kafka.server<type=BrokerTopicMetrics, name=(.+)><>Value", "kafka_broker_topic_metrics_$1",
         {}, "GAUGE", "Kafka broker topic metrics $1"),
    Rule("java.lang<type=Memory><>(HeapMemoryUsage|NonHeapMemoryUsage)", "jvm_memory_$1", {}, "GAUGE",
         "JVM memory usage"),
    Rule("java.lang<type=GarbageCollector, name=(.+)><>CollectionCount", "jvm_gc_collection_count",
         {"gc_collector": "$1"}, "COUNTER"),
    Rule("java.lang<type=GarbageCollector, name=(.+)><>CollectionTime", "jvm_gc_collection_time",
         {"gc_collector": "$1"}, "COUNTER"),
    Rule("java.lang<type=Threading><>(.+)", "jvm_thread_$1", {}, "GAUGE", "JVM thread $1"),
    Rule("java.lang<type=OperatingSystem><>(.+)", "jvm_os_$1", {}, "GAUGE", "Operating System $1"),
)

# Coordination-service rules; the last one keeps every other name.
_LEADER = "org.apache.ZooKeeperService<name0=ReplicatedServer_id[0-9]+,name1=replica.[0-9]+,name2=Leader>:"
COORDINATION_RULES = (
    Rule(_LEADER + "AvgRequestLatency", "zookeeper_avg_request_latency", {}, "GAUGE"),
    Rule(_LEADER + "MaxRequestLatency", "zookeeper_max_request_latency", {}, "GAUGE"),
    Rule(_LEADER + "OutstandingRequests", "zookeeper_outstanding_requests", {}, "GAUGE"),
    Rule(_LEADER + "NumAliveConnections", "zookeeper_num_alive_connections", {}, "GAUGE"),
    Rule(_LEADER + "WatchCount", "zookeeper_watch_count", {}, "GAUGE"),
    Rule(_LEADER + "DataTreeSize", "zookeeper_data_tree_size", {}, "GAUGE"),
    Rule(".*"),
)

FIRST_MATCH = "first_match"
MOST_SPECIFIC = "most_specific"

def _ordered(rules: Sequence[Rule], mode: str) -> list[tuple[int, Rule]]:
    numbered = list(enumerate(rules, start=1))
    if mode == FIRST_MATCH:
        return numbered
    if mode == MOST_SPECIFIC:
        # Most `key=` parts first, then the longest literal text: a rule never hides one that asks for more.
        return sorted(numbered, key=lambda r: (-r[1].pattern.count("="), -len(r[1].pattern.replace("(.+)", ""))))
    raise ValueError(f"unknown mode: {mode!r}")


# Stands between the fields of a rendered rule; not part of any metric name.
_MARK = "\u0001"


def _template(rule: Rule) -> str:
    """Name, help and label values of a rule as one replacement text."""
    return _MARK.join([rule.name or "$0", rule.help or "", *rule.labels.values()])


def _legal(name: Column) -> Column:
    """Characters a metric name may not have become one underscore."""
    merged = F.regexp_replace(name, "[^a-zA-Z0-9:]+", "_")
    # A name that starts with a digit gets an underscore in front, in the same pass over it.
    return F.concat(F.when(F.ascii(name).between(48, 57), "_").otherwise(""), merged)


def rule_number(source: Column, rules: Sequence[Rule], mode: str = FIRST_MATCH) -> Column:
    """The number, from 1, of the rule that applies to a source name; null if none does.

    Patterns may match anywhere in the name. `first_match` tries the rules in
    their order, so a general rule hides later ones; `most_specific` tries those
    with most `key=` parts first, and of those the longest literal text.
    """
    (number, rule), *rest = _ordered(rules, mode)
    chain = F.when(source.rlike(rule.pattern), number)
    for number, rule in rest:
        chain = chain.when(source.rlike(rule.pattern), number)
    return chain


def _of_rule(values: Sequence, kind: str) -> Column:
    """The value that belongs to the row's rule, from one value per rule."""
    return F.element_at(F.array(*[F.lit(value).cast(kind) for value in values]), F.col("_rule"))


def _normalized(rows: DataFrame, others: list[str], rules: Sequence[Rule], mode: str, source: str,
                lower: bool) -> DataFrame:
    """Rows some rule fits, with its result as columns.

    The number is made into rows by an explode: rows no rule fits disappear
    without the patterns being tried a second time in a filter. A rule's fields
    are then filled in with one replacement, so the plan has one such expression
    and not one per rule and field.
    """
    found = rows.select(
        *{*others, source},
        F.explode(F.array_compact(F.array(rule_number(F.col(source), rules, mode)))).alias("_rule"))
    rendered = F.regexp_replace(
        F.translate(source, _MARK, "_"),
        _of_rule([f"(?s)^.*?(?:{rule.pattern}).*$" for rule in rules], "string"),
        _of_rule([_template(rule) for rule in rules], "string"))
    parts = F.col("_parts")
    named = _of_rule([rule.name is not None for rule in rules], "boolean")
    name = F.when(named, _legal(parts[0])).otherwise(F.col(source))
    label_names = [[label.lower() if lower else label for label in rule.labels] for rule in rules]
    labels = F.map_from_arrays(_of_rule(label_names, "array<string>"), F.slice(parts, 3, F.size(parts)))
    return found.withColumn("_parts", F.split(rendered, _MARK)).select(
        *others,
        F.col("_rule").alias("rule"),
        (F.lower(name) if lower else name).alias("name"),
        labels.alias("labels"),
        _of_rule([rule.type for rule in rules], "string").alias("type"),
        F.nullif(parts[1], F.lit("")).alias("help"),
    )


def normalize_names(samples: DataFrame, rules: Sequence[Rule], mode: str = FIRST_MATCH,
                    source: str = "name", lower: bool = True) -> DataFrame:
    """Replace `source` by the normalised columns; samples no rule fits are left out.

    Map-only, so it works on streams too.
    """
    others = [c for c in samples.columns if c != source]
    return _normalized(samples, others, rules, mode, source, lower)
