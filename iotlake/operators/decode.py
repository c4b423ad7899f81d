"""Envelope to typed event rows."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from iotlake.functions.event_time import LAKE_ZONE, event_date, hour_in, hour_of_time, parse_utc
from iotlake.schemas import EVENT

CORRUPT_COLUMN = "_corrupt_record"


def to_text(envelopes: DataFrame) -> DataFrame:
    """Key and value as text, with the envelope time; other columns are not read."""
    return envelopes.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )


def decode(envelopes: DataFrame, schema: T.StructType = EVENT, corrupt: bool = False,
           keep: Iterable[str] = ()) -> DataFrame:
    """Parse the JSON payload once and flatten it; a bad payload gives null fields.

    `corrupt` adds the raw text of payloads that could not be parsed in full;
    `keep` names envelope columns to carry along.
    """
    # No options unless needed: Spark parses only the used fields without them.
    options = {}
    if corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        options = {"columnNameOfCorruptRecord": CORRUPT_COLUMN}
    data = F.from_json(F.col("value").cast("string"), schema, options)
    return envelopes.select(*keep, data.alias("data")).select(*keep, "data.*")


def with_partitions(events: DataFrame, zone: str = LAKE_ZONE, keys: str = "lake") -> DataFrame:
    """Add `date` and `hour`; rows without a readable time get nulls and are kept.

    `keys="lake"` pairs the date as written with the hour in `zone`; a local time
    of day without a date has an hour and no date.
    `keys="utc"` takes both from the UTC instant.
    """
    if keys not in ("lake", "utc"):
        raise ValueError(f"unknown keys: {keys!r}")
    # A column of its own, so that the text is parsed once.
    utc = F.col("_utc")
    timed = events.withColumn("_utc", parse_utc(F.col("timestamp"), zone))
    if keys == "lake":
        date, hour = event_date(F.col("timestamp")), F.coalesce(hour_in(utc, zone), hour_of_time(F.col("timestamp")))
    else:
        date, hour = utc.cast("date"), F.hour(utc)
    return timed.withColumns({"date": date, "hour": hour}).drop("_utc")


def malformed(rows: DataFrame) -> DataFrame:
    """Rows that land in the null partition."""
    return rows.where(F.col("date").isNull())


def dedup_payloads(envelopes: DataFrame) -> DataFrame:
    """The distinct payloads (`value`) of a batch; messages without one are no copies of each other and stay.

    Messages carry no id, so the payload is the key, as it was sent: different
    payloads that cannot be read would decode to the same nulls. Only `value` is
    returned, which makes it a pure grouping: copies collapse in each task before the
    shuffle, so a payload sent millions of times costs one row a task.
    """
    values = envelopes.select("value")
    return values.where("value IS NOT NULL").distinct().unionAll(values.where("value IS NULL"))


def dedup(events: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Distinct rows of the named columns, for callers whose columns name an event."""
    return events.select(*columns).distinct()


def dedup_stream(envelopes: DataFrame, time: str, delay: str, columns: Iterable[str] = ("value",),
                 spread: Iterable[str] = ("partition", "offset"), salts: int = 64) -> DataFrame:
    """Repeated payloads of a stream, removed within the watermark; messages without one stay.

    Copies of one payload are first spread over `salts` groups by `spread`, so
    no task holds all of them, and the at most `salts` survivors meet in a
    second pass. Set `salts` to about the number of state partitions;
    `salts=1` leaves the first pass out.
    """
    columns = list(columns)
    # A message without any of the columns gets a key of its own: its place.
    place = F.when(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNull(),
                   F.concat_ws(":", *[F.col(c).cast("string") for c in spread]))
    rows = envelopes.withWatermark(time, delay).withColumn("_place", place)
    keys = [*columns, "_place"]
    if salts > 1:
        rows = (
            rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
            .dropDuplicatesWithinWatermark(keys + ["_salt"])
            .drop("_salt")
        )
    return rows.dropDuplicatesWithinWatermark(keys).drop("_place")
