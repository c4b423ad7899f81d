from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from iotlake.operators import series
from iotlake.schemas import SAMPLE

START = datetime(2025, 1, 1, 12, 0, 0)
RATE, ERRORS = "kafka_producer_message_rate", "kafka_producer_error_rate"


def at(seconds):
    return START + timedelta(seconds=seconds)


@pytest.fixture
def samples(spark):
    p1 = {"topic": "topic-json", "client_id": "p1", "impl": "ckafka"}
    p2 = {"impl": "ckafka", "client_id": "p2", "topic": "topic-json"}
    old = {"topic": "topic-json"}
    other = {"topic": "topic-parq", "impl": "kpython"}
    return spark.createDataFrame([
        (at(0), RATE, p1, 1.0), (at(1), RATE, p1, 2.0), (at(2), RATE, p1, 4.0),
        (at(1), RATE, p2, 8.0), (at(1), RATE, old, 16.0), (at(1), RATE, other, 32.0),
        (at(1), ERRORS, p1, 64.0),
    ], SAMPLE)


def test_missing_label_is_empty(samples):
    assert rows(series.select_series(samples, RATE, {"impl": ""}), "value") == [(16.0,)]
    assert rows(series.select_series(samples, RATE, {"instance": ""}), "value") == [
        (1.0,), (16.0,), (2.0,), (32.0,), (4.0,), (8.0,)]


def test_regex_matches_the_whole_value(samples):
    def chosen(pattern):
        return sorted(v for v, in rows(series.select_series(samples, RATE, matches={"impl": pattern}), "value"))

    assert chosen("kafka") == []
    assert chosen("c|k") == []
    assert chosen("kpython|") == [16.0, 32.0]
    assert chosen("(ckafka|kpython)") == [1.0, 2.0, 4.0, 8.0, 32.0]
    assert chosen(".*") == [1.0, 2.0, 4.0, 8.0, 16.0, 32.0]
    assert chosen(".+") == [1.0, 2.0, 4.0, 8.0, 32.0]


def test_last_sample_per_step(samples):
    stepped = series.per_step(samples, "2 seconds")
    assert rows(series.select_series(stepped, RATE), "step", "value") == sorted([
        (at(0), 2.0), (at(2), 4.0), (at(0), 8.0), (at(0), 16.0), (at(0), 32.0)], key=repr)


def test_label_order_does_not_split_a_series(spark):
    frame = spark.createDataFrame([
        (at(0), RATE, {"a": "1", "b": "2"}, 1.0), (at(1), RATE, {"b": "2", "a": "1"}, 2.0)], SAMPLE)
    assert rows(series.per_step(frame, "2 seconds"), "value") == [(2.0,)]


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago"])
def test_tie_column_decides_within_one_instant(spark, settings, zone):
    one = {"topic": "t"}
    frame = spark.createDataFrame([
        (at(1), RATE, one, 5.0, 7), (at(1), RATE, one, 6.0, 9), (at(1), RATE, one, 7.0, 8), (at(0), RATE, one, 8.0, 99),
        (at(1), RATE, {"topic": "u"}, 1.0, -2), (at(1), RATE, {"topic": "u"}, 2.0, -1),
        (at(1), RATE, {"topic": "v"}, 1.0, 9223372036854775807), (at(1), RATE, {"topic": "v"}, 2.0, -9223372036854775808),
        (at(1.000001), RATE, {"topic": "v"}, 3.0, -9223372036854775808),
    ], StructType(SAMPLE.fields + [StructField("id", LongType())]))
    with settings({"spark.sql.session.timeZone": zone}):
        assert rows(series.per_step(frame, "2 seconds", tie="id"), "labels", "value") == [
            ({"topic": "t"}, 6.0), ({"topic": "u"}, 2.0), ({"topic": "v"}, 3.0)]


def test_order_holds_through_a_skipped_hour(spark, settings):
    """02:30 does not exist in this zone on that day; 03:10 is later all the same."""
    early, late = datetime(2025, 3, 9, 2, 30), datetime(2025, 3, 9, 3, 10)
    frame = spark.createDataFrame([(early, RATE, {}, 1.0), (late, RATE, {}, 2.0)], SAMPLE).withColumn("id", F.lit(1))
    with settings({"spark.sql.session.timeZone": "America/Chicago"}):
        for tie in (None, "id"):
            assert rows(series.per_step(frame, "1 day", tie=tie), "value") == [(2.0,)]


def test_sums(samples):
    stepped = series.select_series(series.per_step(samples, "10 seconds"), RATE)
    assert rows(series.sum_by(stepped, "topic")) == [(at(0), "topic-json", 28.0), (at(0), "topic-parq", 32.0)]
    by_both = series.sum_by(stepped, "topic", "impl")
    assert rows(by_both) == [(at(0), "topic-json", "", 16.0), (at(0), "topic-json", "ckafka", 12.0),
                             (at(0), "topic-parq", "kpython", 32.0)]
    again = by_both.groupBy("step", "topic").agg(F.sum("total").alias("total"))
    assert rows(again) == rows(series.sum_by(stepped, "topic"))


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1] * 10 + [1e9, -1e9]
    frame = spark.createDataFrame([(at(0), RATE, {"c": str(i)}, v) for i, v in enumerate(values)], SAMPLE)
    stepped = series.per_step(frame, "1 second")
    assert rows(series.sum_by(stepped, scale=6), "total") == [(1.0,)]


def test_label_values(samples):
    assert rows(series.label_values(samples, RATE, "impl", "instance")) == [("impl", "ckafka"), ("impl", "kpython")]


def test_time_range_leaves_its_start_out(samples):
    assert rows(series.time_range(samples, at(2), minutes=1 / 60), "value") == [(4.0,)]
    assert series.time_range(samples, at(2)).count() == samples.count()


def test_display_name(samples):
    named = series.with_display_name(series.select_series(samples, RATE, {"topic": "topic-json"}), "client_id")
    assert {r.series for r in named.collect()} == {"p1", "p2", ""}


def test_listed_targets_rename_what_they_replace(samples):
    scraped = samples.withColumn("job", F.lit("j")).withColumn(
        "instance", F.when(F.col("value") == 4.0, "elsewhere").otherwise("h:1"))
    labelled = series.with_listed_targets(scraped, {"j": (["h:1", "h:2"], {"impl": "new"}), "k": (["h:1"], {})})
    result = {r.value: r.labels for r in labelled.collect()}
    assert result[16.0] == {"topic": "topic-json", "impl": "new", "job": "j", "instance": "h:1"}
    assert result[32.0] == {"topic": "topic-parq", "exported_impl": "kpython", "impl": "new", "job": "j", "instance": "h:1"}
    assert "job" not in result[4.0]


def test_label_values_of_listed_targets_need_no_map(spark, samples):
    targets = {"j": (["h:1", "h:2"], {"impl": "new"}), "k": (["h:1"], {})}
    scraped = samples.withColumn("job", F.when(F.col("value") < 8.0, "j").otherwise("k")).withColumn(
        "instance", F.when(F.col("value") == 4.0, "elsewhere").when(F.col("value") == 2.0, "h:2").otherwise("h:1"))
    names = ["topic", "impl", "exported_impl", "job", "instance", "client_id", "other"]
    whole = series.label_values(series.with_listed_targets(scraped, targets), RATE, *names)
    assert rows(series.label_values(scraped, RATE, *names, targets=targets)) == rows(whole)


def test_every_producer_job_is_listed(spark):
    rows_ = [(job, instance) for job, (instances, _) in series.TARGETS.items() for instance in instances]
    frame = spark.createDataFrame(rows_, "job string, instance string").withColumn(
        "labels", F.create_map().cast("map<string,string>"))
    labels = [r.labels for r in series.with_listed_targets(frame).collect()]
    assert len(labels) == 8 and {x["job"] for x in labels} == set(series.TARGETS)
    assert sum("impl" in x for x in labels) == 6


def test_label_patterns_match_the_whole_value(spark):
    frame = spark.createDataFrame([("ckafka",), ("ckafka\n",), ("a\nb",)], "v string").select(
        F.create_map(F.lit("impl"), F.col("v")).alias("labels"))
    assert series.select_series(frame, matches={"impl": "ckafka"}).count() == 1
    assert series.select_series(frame, matches={"impl": "a.b"}).count() == 1


def counter(spark, values, labels=None, metric="c"):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(start + timedelta(seconds=s), metric, labels or {"a": "1", "b": "2"}, v) for s, v in values], SAMPLE)


def test_per_type(spark):
    values = [(0, 5.0), (60, 9.0), (120, 7.0)]
    frame = counter(spark, values).unionByName(counter(spark, values, metric="g")).unionByName(counter(spark, values[:1], metric="n"))
    kind = F.when(F.col("metric") == "c", "COUNTER").when(F.col("metric") == "g", "GAUGE")
    assert rows(series.per_type(frame, "1 hour", kind), "metric", "type", "value") == [
        ("c", "COUNTER", 11.0), ("g", "GAUGE", 7.0), ("n", None, 5.0)]


@pytest.mark.parametrize("run", [1, 2, 10_000])
def test_increase_counts_restarts_and_goes_on_over_steps(spark, run):
    values = [(0, 0.0), (10, 5.0), (20, 10.0), (30, 2.0), (40, 4.0), (60, 9.0), (250, 20.0), (260, None), (600, 1.0)]
    found = series.increase(counter(spark, values).repartition(5), "1 minute", run=run)
    start = datetime(2024, 1, 1)
    assert {r.step: r.value for r in found.collect()} == {
        start: 14.0, start + timedelta(minutes=1): 5.0, start + timedelta(minutes=4): 11.0, start + timedelta(minutes=10): 1.0}


def test_increase_keeps_series_apart(spark):
    frame = counter(spark, [(0, 1.0), (100, 4.0)], {"x": "1"}).unionByName(counter(spark, [(50, 2.0), (110, 3.0)], {"x": "2"})).unionByName(
        counter(spark, [(0, 7.0), (61, 8.0)], {"z": "1", "x": "1"})).unionByName(counter(spark, [(70, 9.0)], {"x": "1", "z": "1"}))
    found = {(tuple(sorted(r.labels.items())), r.step.minute): r.value for r in series.increase(frame, "1 minute").collect()}
    assert found == {((("x", "1"),), 0): 0.0, ((("x", "1"),), 1): 3.0, ((("x", "2"),), 0): 0.0, ((("x", "2"),), 1): 1.0,
                     ((("x", "1"), ("z", "1")), 0): 0.0, ((("x", "1"), ("z", "1")), 1): 2.0}


def test_increase_equals_a_fold_on_the_whole_table(events):
    from collections import defaultdict

    from iotlake.plans import inputs

    frame = inputs.one_per_instant(inputs.samples(events))
    expected, before = defaultdict(float), {}
    for r in sorted(frame.collect(), key=lambda r: r.ts):
        key = (r.metric, tuple(sorted(r.labels.items())))
        last = before.get(key)
        step = r.ts.replace(hour=r.ts.hour // 6 * 6, minute=0, second=0, microsecond=0)
        expected[key, step] += 0 if last is None else r.value - last if r.value >= last else r.value
        before[key] = r.value
    found = {((r.metric, tuple(sorted(r.labels.items()))), r.step): r.value for r in series.increase(frame, "6 hours", scale=2, run=3).collect()}
    assert found == {k: pytest.approx(v, abs=1e-6) for k, v in expected.items()}


def test_target_labels_keep_samples_without_target(spark, samples):
    targets = spark.createDataFrame([("json", {"impl": "x"})], "job string, target_labels map<string,string>")
    job = F.when(F.col("labels")["topic"] == "topic-json", "json").otherwise("none")
    result = {r.value: r.labels for r in series.with_target_labels(samples.withColumn("job", job), targets).collect()}
    assert len(result) == samples.count()
    assert result[16.0] == {"topic": "topic-json", "impl": "x"}
    assert result[32.0] == {"topic": "topic-parq", "impl": "kpython"}
