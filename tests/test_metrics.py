from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from iotlake.operators import metrics
from iotlake.schemas import DELIVERY

START = datetime(2025, 1, 1, 12, 0, 0)


def at(seconds):
    return START + timedelta(seconds=seconds)


@pytest.fixture
def deliveries(spark):
    sent = [
        (at(0), "a", "a-p1", 0.5, "ok"),
        (at(3), "a", "a-p1", 1.5, "error"),
        (at(9.999999), "a", "a-p2", 2.0, "ok"),
        (at(10), "a", "a-p1", 0.25, "ok"),
        (at(31), "a", "a-p1", None, "error"),
        (at(5), "b", "b-p1", 1.0, "ok"),
    ]
    return spark.createDataFrame(sent, DELIVERY)


def test_windows_per_client(deliveries):
    result = metrics.producer_metrics(deliveries).drop("first_ts", "window", "window_end")
    assert rows(result) == sorted([
        ("a", "a-p1", at(0), 2, 0.2, 1, 0.1, 1, 1.0),
        ("a", "a-p2", at(0), 1, 0.1, 0, 0.0, 0, 2.0),
        ("a", "a-p1", at(10), 1, 0.1, 0, 0.0, 0, 0.25),
        ("a", "a-p1", at(30), 1, 0.1, 1, 0.1, 1, 0.0),
        ("b", "b-p1", at(0), 1, 0.1, 0, 0.0, 0, 1.0),
    ], key=repr)


def test_second_family_never_drops_and_is_keyed_by_topic(deliveries):
    result = metrics.producer_metrics(deliveries, ["topic"], family=metrics.CKAFKA)
    assert rows(result, "topic", "window_start", "msg_count", "error_count", "dropped_count") == sorted([
        ("a", at(0), 3, 1, 0), ("a", at(10), 1, 0, 0), ("a", at(30), 1, 1, 0), ("b", at(0), 1, 0, 0)], key=repr)


def test_unknown_family(deliveries):
    with pytest.raises(ValueError):
        metrics.producer_metrics(deliveries, family="other")


def test_messages_add_up_on_the_whole_table(events):
    from iotlake.plans import inputs

    sent = inputs.deliveries(events)
    for width in ("10 seconds", "7 minutes", "1 day"):
        total = metrics.producer_metrics(sent, width=width).agg(F.sum("msg_count"), F.sum("error_count")).first()
        assert tuple(total) == (events.count(), events.where("event_type = 'error'").count())


@pytest.mark.parametrize("width", ["10 seconds", "3 hours", "1 day", "2 days"])
def test_observed_gap_equals_row_by_row(events, width):
    from iotlake.plans import inputs

    sent = inputs.deliveries(events)
    result = {
        (r.topic, r.window_start): (r.n, r.avg_delay)
        for r in metrics.observed_gap(sent, ["topic"], width).collect()}

    micros = lambda t: round((t - datetime(1970, 1, 1)) / timedelta(microseconds=1))
    amount, unit = width.split()
    length = int(amount) * {"seconds": 1, "hours": 3600, "day": 86400, "days": 86400}[unit] * 1_000_000
    times = defaultdict(list)
    for r in sent.collect():
        times[r.topic].append(micros(r.ts))
    expected = defaultdict(lambda: [0, []])
    for topic, moments in times.items():
        moments.sort()
        for i, moment in enumerate(moments):
            entry = expected[topic, datetime(1970, 1, 1) + timedelta(microseconds=moment // length * length)]
            entry[0] += 1
            if i:
                entry[1].append(moment - moments[i - 1])
    assert set(result) == set(expected)
    for key, (n, gaps) in expected.items():
        assert result[key][0] == n
        mean = sum(gaps) / 1e6 / len(gaps) if gaps else None
        assert result[key][1] == (pytest.approx(mean, rel=1e-12) if gaps else None)


def test_gaps_of_equal_times(spark):
    sent = spark.createDataFrame([(at(s), "a", "c", 0.0, "ok") for s in (1, 1, 1, 4)], DELIVERY)
    assert rows(metrics.observed_gap(sent), "n", "avg_delay") == [(4, 1.0)]
    alone = spark.createDataFrame([(at(1), "a", "c", 0.0, "ok")], DELIVERY)
    assert rows(metrics.observed_gap(alone), "n", "avg_delay") == [(1, None)]


def test_elapsed_counts_from_the_first_message_of_the_run(deliveries):
    result = metrics.with_elapsed(metrics.producer_metrics(deliveries))
    assert rows(result, "topic", "client_id", "window_start", "elapsed_seconds") == sorted([
        ("a", "a-p1", at(0), 10.0), ("a", "a-p2", at(0), 10.0), ("a", "a-p1", at(10), 20.0),
        ("a", "a-p1", at(30), 40.0), ("b", "b-p1", at(0), 5.0)], key=repr)


def test_elapsed_keeps_windows_without_a_topic(spark):
    sent = spark.createDataFrame([(at(1), None, "c", 0.0, "ok"), (at(2), "a", "c", 0.0, "ok")], DELIVERY)
    result = metrics.with_elapsed(metrics.producer_metrics(sent))
    assert rows(result, "topic", "elapsed_seconds") == [("a", 8.0), (None, 9.0)]


def test_current_lambda(spark):
    nan = float("nan")
    controls = spark.createDataFrame([
        (at(0), "a", 5.0), (at(60), "a", 10.0), (at(90), "a", None),
        (at(0), "b", 5.0), (at(60), "b", -3.0),
        (at(0), "c", 1.0), (at(0), "c", 2.0),
        (at(0), "d", nan),
    ], "ts timestamp_ntz, topic string, lambda double")
    assert rows(metrics.current_lambda(controls)) == [("a", 10.0), ("b", 0.0), ("c", 2.0), ("d", 0.0)]
    assert rows(metrics.current_lambda(controls, clamp=False))[:3] == [("a", 10.0), ("b", -3.0), ("c", 2.0)]
    assert metrics.lambda_samples(controls).where("value < 0 OR isnan(value)").count() == 0


def test_samples_and_closing_zeros(deliveries):
    samples = metrics.to_samples(metrics.producer_metrics(deliveries))
    assert samples.count() == 4 * 5
    first = samples.where((F.col("ts") == at(10)) & (F.col("labels")["client_id"] == "a-p1"))
    assert dict(rows(first, "metric", "value")) == {
        metrics.MESSAGE_RATE: 0.2, metrics.DROPPED_MESSAGES: 1.0, metrics.ERROR_RATE: 0.1, metrics.AVG_DELAY: 1.0}

    closed = metrics.with_stop_zeros(samples, after="2 seconds")
    zeros = metrics.stop_samples(samples)
    assert closed.count() == samples.count() + 3 * 3
    assert zeros.where(F.col("metric") == metrics.DROPPED_MESSAGES).count() == 0
    assert {r.ts for r in zeros.where("labels['client_id'] = 'a-p1'").collect()} == {at(42)}


def test_topic_only_samples_have_no_client_label(deliveries):
    by_topic = metrics.producer_metrics(deliveries, ["topic"])
    samples = metrics.to_samples(by_topic, ["topic"])
    assert {tuple(r.labels) for r in samples.collect()} == {("topic",)}


SENDS = "ts timestamp_ntz, topic string, client_id string, message_id long, planned_delay double, status string"
REPORTS = "message_id long, ts timestamp_ntz, status string"


@pytest.fixture
def reported(spark):
    sends = [(at(0), "a", "c", 1, 0.5, "sent"), (at(2), "a", "c", 2, 1.5, "sent"), (at(3), "a", "c", 3, 9.0, "refused"),
             (at(12), "a", "c", 4, None, "sent"), (at(13), None, "d", 5, 1.0, "sent"), (at(14), "a", "c", None, 1.0, "sent"),
             (at(15), "a", "c", 6, 2.0, "sent")]
    reports = [(1, at(25), "error"), (2, at(2), "ok"), (3, at(4), "error"), (4, at(72.000001), "error"), (5, at(73), "error"),
               (None, at(15), "error"), (7, at(1), "error"), (6, at(14.999999), "error")]
    return spark.createDataFrame(sends, SENDS), spark.createDataFrame(reports, REPORTS)


def test_an_error_counts_in_the_window_of_its_report(reported):
    found = metrics.reported_metrics(*reported, within="1 minute")
    assert rows(found, "topic", "client_id", "window_start", "msg_count", "error_count", "dropped_count", "avg_delay") == sorted([
        ("a", "c", at(0), 2, 0, 0, 1.0), ("a", "c", at(10), 3, 0, 0, 1.0), ("a", "c", at(20), 0, 1, 0, 0.0),
        (None, "d", at(10), 1, 0, 0, 1.0), (None, "d", at(70), 0, 1, 0, 0.0)], key=repr)
    assert rows(found.where("error_count = 1"), "rate", "error_rate") == [(0.0, 0.1)] * 2


def test_sends_without_a_report_in_time(reported):
    assert rows(metrics.unreported(*reported, within="1 minute"), "message_id", "ts") == sorted(
        [(4, at(12)), (None, at(14)), (6, at(15))], key=repr)


def test_a_client_stops_once_per_gap(spark):
    label = {"topic": "t", "client_id": "c"}
    samples = spark.createDataFrame(
        [(at(s), m, label, 1.0) for s in (0, 5, 14, 40, 49, 90) for m in (metrics.MESSAGE_RATE, metrics.DROPPED_MESSAGES)]
        + [(at(5), metrics.MESSAGE_RATE, {"client_id": "d", "topic": "t"}, 1.0)], "ts timestamp_ntz, metric string, labels map<string,string>, value double")
    zeros = metrics.stop_samples(samples, gap="10 seconds")
    assert rows(zeros, "ts", "metric", "value") == sorted(
        [(at(s + 2), metrics.MESSAGE_RATE, 0.0) for s in (14, 49, 90, 5)], key=repr)
    assert metrics.with_stop_zeros(samples, gap="10 seconds").count() == samples.count() + 4


def folded(sent, width):
    """Windows of one client's messages (ts, planned_delay, status), one after the other."""
    out, opened, n, errors, delay = [], None, 0, 0, 0.0
    for ts, planned, status in sent:
        opened = opened or ts
        n, errors, delay = n + 1, errors + (status == "error"), delay + (planned or 0.0)
        if ts - opened >= width:
            seconds = (ts - opened) / timedelta(seconds=1)
            out.append((opened, ts, n, n / seconds, errors, errors / seconds, delay / n))
            opened, n, errors, delay = ts, 0, 0, 0.0
    return out


@pytest.mark.parametrize("width,hours", [("6 hours", 6), ("3 days", 72)])
def test_client_windows_equal_a_fold(events, width, hours):
    from iotlake.operators.client_windows import client_windows
    from iotlake.plans import inputs

    sent = inputs.deliveries(events, "event_id")
    clients = defaultdict(list)
    for r in sorted(sent.collect(), key=lambda r: (r.ts, r.event_id)):
        clients[r.topic, r.client_id].append((r.ts, r.planned_delay, r.status))
    expected = sorted((*key, *w) for key, own in clients.items() for w in folded(own, timedelta(hours=hours)))
    found = client_windows(sent, width=width, tie="event_id", run=3)
    assert sorted(map(tuple, found.collect())) == expected and len(expected) > 20


def test_client_windows_of_ties_gaps_and_missing_keys(spark):
    from iotlake.operators.client_windows import client_windows

    times = [0, 0, 3, 9.999999, 10, 10, 10, 12, 20, 100, 100, 105, 110.5, 111, 300]
    rows_ = [(at(s), None if k == 2 else "t", f"c{k}", i / 4, "error" if i % 3 == 0 else "ok", i)
             for k in (1, 2) for i, s in enumerate(times)] + [(None, "t", "c1", 1.0, "ok", 99), (at(1), "t", "alone", 1.0, "ok", 0)]
    frame = spark.createDataFrame(rows_, "ts timestamp_ntz, topic string, client_id string, planned_delay double, status string, i long")
    expected = folded([(at(s), i / 4, "error" if i % 3 == 0 else "ok") for i, s in enumerate(times)], timedelta(seconds=10))
    for run in (1, 10_000):
        found = client_windows(frame.repartition(3), tie="i", run=run).collect()
        assert sorted((tuple(r) for r in found), key=repr) == sorted(((t, c, *w) for t, c in (("t", "c1"), (None, "c2")) for w in expected), key=repr)
    assert client_windows(frame.where("i < 0")).count() == 0


def test_client_windows_plan_has_no_loop_over_a_client(spark, deliveries):
    from conftest import plan

    from iotlake.operators.client_windows import _closing

    instants = deliveries.select("topic", F.unix_micros(F.col("ts").cast("timestamp")).alias("t")).withColumn("slot", F.floor(F.col("t") / 10))
    text = plan(_closing(instants, ["topic"], F.lit(10), 100))
    assert "Python" not in text and "Cartesian" not in text


def test_client_windows_go_through_every_instant_at_one_level_alone(events, monkeypatch):
    """What is stored of jumps over many windows is a fraction of the instants, however many windows follow one another."""
    from iotlake.operators import client_windows as module
    from iotlake.plans import inputs

    sent, rows, stored = inputs.deliveries(events, "event_id"), [], module.stored

    def counted(frame, purpose):
        out = stored(frame, purpose)
        rows.append((purpose, out.count()))
        return out

    monkeypatch.setattr(module, "stored", counted)
    assert module.client_windows(sent, width="6 hours", tie="event_id").count() > 100
    one, *longer = [n for purpose, n in rows if purpose == "window-jumps"]
    assert len(longer) > 1 and sum(longer) < one


def test_sessions_of_a_batch_are_made_of_slots_not_samples(spark):
    """A busy series reaches the ordering of its sessions with two samples a slot at most; the zeros are those of all samples."""
    from random import Random

    rng, at, times = Random(3), 0, []
    for _ in range(4000):
        at += rng.choice([1, 2, 30, 59, 61, 200]) * 1_000_000 if rng.random() < 0.05 else rng.randrange(1_000_000)
        times.append(at)
    frame = spark.createDataFrame([(t,) for t in times] + [(None,)], "t long").select(
        F.timestamp_micros("t").alias("ts"), F.lit(metrics.MESSAGE_RATE).alias("metric"),
        F.create_map(F.lit("topic"), F.lit("a")).alias("labels"), F.lit(1.0).alias("value"))
    found = metrics.stop_samples(frame, gap="1 minute")
    got = sorted(r.t - 2_000_000 for r in found.select(F.unix_micros("ts").alias("t")).collect())
    last = [a for a, b in zip(times, [*times[1:], None]) if b is None or b - a > 60_000_000]
    assert len(last) > 20 and got == last
    assert 2 * len({t // 60_000_000 for t in times}) < len(times)
    assert "_first" in found._jdf.queryExecution().executedPlan().toString()
