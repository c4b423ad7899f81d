"""Physical plans: what is read, what is shuffled, what stays out of the driver."""

import re
from datetime import datetime

import compare
import pytest
from conftest import SF, plan
from pyspark.sql import functions as F

import __spark_entry__ as contract
from iotlake.operators import decode, metrics, monitor, series
from iotlake.plans import inputs, jobs
from iotlake.sources.lake import read_lake, read_lake_between
from iotlake.streaming.sinks import write_lake_batch
from test_oracle import ORACLE, QUERIES, WRITES_FILES

PLANNED = sorted(set(QUERIES) - WRITES_FILES)
JOINS = ["consumer_lag", "target_labels", "run_elapsed", "producer_delay"]


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_no_cross_join_and_partial_aggregates(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"Python|Cartesian|NestedLoop|SortAggregate|SinglePartition|InMemoryRelation", text)
    finals = len(re.findall(r"HashAggregate\(keys", text))
    assert finals % 2 == 0
    assert text.count("Exchange") == 0 or finals or "Join" in text


@pytest.mark.parametrize("name", JOINS)
def test_joins_give_the_same_rows_without_broadcast(spark, settings, name):
    with settings({"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        frame = QUERIES[name](spark, SF)
        assert "Broadcast" not in plan(frame)
        only_spark, only_sql, _ = compare.differences(frame, compare.connect(SF), ORACLE[name])
        assert not only_spark and not only_sql


def test_payload_is_parsed_once_and_only_values_are_read(spark, events, tmp_path):
    inputs.envelopes(events).write.parquet(str(tmp_path / "e"))
    text = plan(jobs.lake_rows(spark.read.parquet(str(tmp_path / "e"))))
    assert text.count("from_json(") == 1
    assert "ReadSchema: struct<value:binary>" in text
    assert "Exchange" not in text
    # The time text is cast to a date once, and to an instant in one place, in four ways.
    assert len(re.findall(r"try_cast\(timestamp#\d+ as date\)", text)) == 1
    assert len(re.findall(r"try_cast\(data#\d+.timestamp as timestamp", text)) == 4


def test_one_field_prunes_the_parse(spark, events, tmp_path):
    inputs.envelopes(events).write.parquet(str(tmp_path / "e"))
    text = plan(decode.decode(spark.read.parquet(str(tmp_path / "e"))).select("device_id"))
    assert re.search(r"from_json\(StructField\(device_id,StringType,true\), cast", text)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "out")
    frame = jobs.lake_rows(inputs.envelopes(inputs.events(spark, SF))).where("date < '2024-01-04'")
    write_lake_batch(frame, "parquet", path)
    return path


def test_lake_filters_prune_partitions(spark, lake):
    text = plan(read_lake(spark, lake, "parquet", date="2024-01-02", hour=5))
    assert re.search(r"PartitionFilters: \[.*date.*hour.*\]", text)
    between = read_lake_between(spark, lake, "parquet", datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert re.search(r"PartitionFilters: \[[^]]*date#\d+ >= 2024-01-01[^]]*date#\d+ <= 2024-01-04", plan(between))


def test_counting_a_lake_reads_no_column(spark, lake):
    assert "ReadSchema: struct<>" in plan(monitor.partition_counts(read_lake(spark, lake, "parquet")))


def test_newest_files_is_a_top_n(spark, lake):
    text = plan(monitor.newest_files(spark, lake))
    assert "TakeOrderedAndProject" in text
    assert "content" not in text.split("ReadSchema")[1]


def test_clustered_write_splits_a_hot_partition(spark, settings, tmp_path):
    """Half of all rows in the null partition: several tasks share it."""
    frame = spark.range(400_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("device_id"), F.lit(1).alias("battery_level"),
        F.lit(True).alias("motion_detected"), F.lit("x").alias("timestamp"),
        F.when(F.col("id") % 2 == 0, F.lit("2024-01-01").cast("date")).alias("date"),
        F.when(F.col("id") % 2 == 0, 1).alias("hour"))
    path = str(tmp_path / "out")
    with settings({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}):
        write_lake_batch(frame, "parquet", path)
    files = read_lake(spark, path, "parquet").where("date IS NULL").select("_metadata.file_path").distinct().count()
    assert files > 4
    assert read_lake(spark, path, "parquet").count() == 400_000


def test_time_range_and_metric_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "samples")
    inputs.samples(inputs.events(spark, SF)).write.parquet(path)
    chosen = series.select_series(spark.read.parquet(path), metrics.MESSAGE_RATE)
    text = plan(series.time_range(chosen, "2024-01-15 12:00:00").select("ts", "value"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: (.*)", text)
    assert "EqualTo(metric" in pushed[1] and "GreaterThan(ts" in pushed[1] and "LessThanOrEqual(ts" in pushed[1]
    assert "labels" not in pushed[2]


def test_end_offsets_read_two_columns(spark):
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan(contract.queries()["end_offsets"](spark, SF))


@pytest.mark.parametrize("name", ["scraped_impl", "normalize_names", "normalize_coordination", "error_panel"])
def test_samples_are_not_shuffled(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "Exchange" not in text and "Join" not in text


@pytest.mark.parametrize("name,most", [("lambda_current", 16), ("label_values", 64), ("producer_delay", 200)])
def test_shuffled_rows_stay_few_with_any_broadcast_limit(spark, settings, name, most):
    """Rows that the exchanges wrote, with the limit below the input's size."""
    with settings({"spark.sql.autoBroadcastJoinThreshold": "10KB"}):
        frame = QUERIES[name](spark, SF)
        frame.collect()
        executed = frame._jdf.queryExecution().executedPlan()
        assert sum(_shuffled(executed)) <= most


def _shuffled(node):
    """shuffleRecordsWritten of every exchange below a node."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _shuffled(node.executedPlan())
        return
    if kind.endswith("QueryStageExec"):
        yield from _shuffled(node.plan())
        return
    found = node.metrics().get("shuffleRecordsWritten")
    if found.isDefined():
        yield found.get().value()
    children = node.children()
    for i in range(children.size()):
        yield from _shuffled(children.apply(i))
