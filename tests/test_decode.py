from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from iotlake.operators import decode
from iotlake.schemas import EVENT

AT = "2025-01-15T03:04:05Z"


def event(**fields):
    values = {"device_id": '"iot_device_7"', "battery_level": "85", "motion_detected": "true", "timestamp": f'"{AT}"'}
    values.update(fields)
    return "{" + ",".join(f'"{k}":{v}' for k, v in values.items() if v is not None) + "}"


GOOD = ("iot_device_7", 85, True, AT, date(2025, 1, 15), 21)
NOTHING = (None,) * 6


def changed(position, value):
    return GOOD[:position] + (value,) + GOOD[position + 1:]


def untimed(text):
    return GOOD[:3] + (text, None, None)


# Payload, lake row, and whether the corrupt column is set.
CASES = {
    "valid": (event(), GOOD, False),
    "valid with fraction": (event(timestamp='"2025-01-15T03:04:05.123456Z"'),
                            changed(3, "2025-01-15T03:04:05.123456Z"), False),
    "truncated": (event()[:30], NOTHING, True),
    "plain text": ("hello", NOTHING, True),
    "empty": ("", NOTHING, False),
    "null": (None, NOTHING, False),
    "empty object": ("{}", NOTHING, False),
    "extra key": (event(rssi="-70"), GOOD, False),
    "battery as text": (event(battery_level='"85"'), changed(1, None), True),
    "battery with fraction": (event(battery_level="85.5"), changed(1, None), True),
    "battery too large": (event(battery_level="3000000000"), changed(1, None), True),
    "device as number": (event(device_id="7"), changed(0, "7"), False),
    "motion as text": (event(motion_detected='"true"'), changed(2, None), True),
    "time as number": (event(timestamp="1736910245"), untimed("1736910245"), False),
    "time as word": (event(timestamp='"yesterday"'), untimed("yesterday"), False),
    "array": (f"[{event()},{event()}]", NOTHING, True),
    "wrong key case": (event(device_id=None, Device_ID='"x"'), changed(0, None), False),
    "duplicate key": ('{"battery_level":1,' + event()[1:], GOOD, False),
    "no time": (event(timestamp=None), untimed(None), False),
}


@pytest.fixture
def envelopes(spark):
    return spark.createDataFrame(
        [(name, payload) for name, (payload, _, _) in CASES.items()], "topic string, payload string"
    ).withColumn("value", F.col("payload").cast("binary"))


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Asia/Tokyo"])
def test_payloads(envelopes, settings, ansi, zone):
    with settings({"spark.sql.ansi.enabled": ansi, "spark.sql.session.timeZone": zone}):
        result = decode.with_partitions(decode.decode(envelopes, keep=["topic"]))
        assert {r[0]: tuple(r[1:]) for r in result.collect()} == {k: v[1] for k, v in CASES.items()}


def test_corrupt_column(envelopes):
    result = decode.decode(envelopes, corrupt=True, keep=["topic"])
    raw = {r.topic: r[decode.CORRUPT_COLUMN] for r in result.collect()}
    assert raw == {name: payload if corrupt else None for name, (payload, _, corrupt) in CASES.items()}


def test_malformed_rows_are_the_null_partition(envelopes):
    result = decode.malformed(decode.with_partitions(decode.decode(envelopes, keep=["topic"])))
    assert {r.topic for r in result.collect()} == {name for name, case in CASES.items() if case[1][4] is None}


def test_rows_are_kept(envelopes):
    assert decode.with_partitions(decode.decode(envelopes)).count() == len(CASES)


def test_text_projection(spark):
    frame = spark.sql(
        "SELECT cast('k' AS binary) key, cast('v' AS binary) value, timestamp'2025-01-01' timestamp, 1 offset")
    text = decode.to_text(frame)
    assert text.dtypes == [("key", "string"), ("value", "string"), ("timestamp", "timestamp")]
    assert tuple(text.first())[:2] == ("k", "v")


@pytest.mark.parametrize("text,day,hour,utc_hour", [
    ("2025-01-15T03:04:05Z", date(2025, 1, 15), 21, 3),
    ("2025-07-15T03:04:05Z", date(2025, 7, 15), 22, 3),
    ("2025-11-02T06:30:00Z", date(2025, 11, 2), 1, 6),
    ("2025-11-02T07:30:00Z", date(2025, 11, 2), 1, 7),
    ("2025-03-09T00:30:00Z", date(2025, 3, 9), 18, 0),
    ("2025-03-09T23:30:00Z", date(2025, 3, 9), 18, 23),
    ("2025-03-09T08:00:00Z", date(2025, 3, 9), 3, 8),
    ("2025-01-15T03:04:05+02:00", date(2025, 1, 15), 19, 1),
    ("2025-01-15 03:04:05 Europe/Paris", date(2025, 1, 15), 20, 2),
    ("2025-01-15T03:04:05", date(2025, 1, 15), 3, 9),
    ("2025-01-15", date(2025, 1, 15), 0, 6),
    ("2025-01-15T03", date(2025, 1, 15), 3, 9),
    ("2025-01-15 3:04", date(2025, 1, 15), 3, 9),
    ("2025-01-15T03:04:00+05:30", date(2025, 1, 15), 15, 21),
    ("12:30:00", None, 12, None),
    ("T12:30", None, 12, None),
    ("25:30", None, None, None),
    ("12:30:00Z", None, None, None),
    ("12:30+02:00", None, None, None),
])
@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Asia/Tokyo"])
def test_zone_table(spark, settings, zone, text, day, hour, utc_hour):
    with settings({"spark.sql.session.timeZone": zone}):
        frame = spark.createDataFrame([(text,)], "timestamp string")
        assert tuple(decode.with_partitions(frame).first())[1:] == (day, hour)
        assert decode.with_partitions(frame, keys="utc").first()["hour"] == utc_hour


def test_utc_date_differs_from_the_written_one(spark):
    frame = spark.createDataFrame([("2025-01-15T03:04:05+05:00",)], "timestamp string")
    assert decode.with_partitions(frame).first()["date"] == date(2025, 1, 15)
    assert decode.with_partitions(frame, keys="utc").first()["date"] == date(2025, 1, 14)


@pytest.mark.parametrize("day,missing", [("2025-11-02", 18), ("2025-03-09", 2)])
def test_change_days_have_23_keys(spark, day, missing):
    frame = spark.range(24).select(F.format_string(f"{day}T%02d:30:00Z", "id").alias("timestamp"))
    hours = {r["hour"] for r in decode.with_partitions(frame).collect()}
    assert hours == set(range(24)) - {missing}


@pytest.mark.parametrize("text", ["+294247-01-10T04:00:54Z", "-290308-12-21T19:59:06Z", "9999999-01-01T00:00:00Z",
                                  "2025-13-45T99:99:99Z", "ZZZ", "Z", "+-:Z", "2025-01-15T03:04:05+99:00"])
def test_odd_times_never_fail(spark, text):
    frame = spark.createDataFrame([(text,)], "timestamp string")
    for keys in ("lake", "utc"):
        result = decode.with_partitions(frame, keys=keys)
        assert len(result.select(F.col("date").cast("string"), "hour").collect()) == 1


def test_unknown_keys_are_refused(spark):
    with pytest.raises(ValueError):
        decode.with_partitions(spark.createDataFrame([("x",)], "timestamp string"), keys="local")


def test_dedup_keeps_one_of_each_payload(spark):
    payloads = [event()] * 50 + [event(battery_level="2"), "cut {", "cut {", "other {", "", None, None]
    frame = spark.createDataFrame([(p,) for p in payloads], "payload string").select(
        F.col("payload").cast("binary").alias("value"))
    # Different unreadable payloads stay apart, and messages without one are no copies.
    assert decode.dedup_payloads(frame).count() == 7
    assert decode.decode(decode.dedup_payloads(frame)).where("device_id IS NULL").count() == 5


def test_dedup_by_named_columns(spark):
    frame = spark.createDataFrame([("d", 1, True, AT)] * 5 + [("d", 2, True, AT)], EVENT)
    assert rows(decode.dedup(frame, ["device_id"])) == [("d",)]
