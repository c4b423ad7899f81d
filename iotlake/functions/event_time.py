"""Zone-explicit time expressions.

None of these reads the session time zone or the present date, so a query gives the
same rows whenever and in whatever zone the cluster runs.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The zone the lake's `hour` key is rendered in.
LAKE_ZONE = "America/Chicago"

# Text that names a zone: a time of day, then an offset or a zone's name.
_ZONED = r"[T ]\d{1,2}(:\d{1,2}(:\d{1,2}(\.\d*)?)?)?\s*([+-]\d|[A-Za-z])"

# A time of day and no date; its hour is the group.
_TIME_ONLY = r"^\s*T?(\d{1,2}):\d{1,2}(:\d{1,2}(\.\d*)?)?\s*$"
_NO_DATE = r"^\s*T?\d{1,2}:"

# Below this a zone shift can leave the 64-bit microsecond range.
_FIRST_SHIFTABLE = "-290000-01-01 00:00:00"


def ntz_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a timestamp without zone, read as UTC."""
    seconds = F.extract(F.lit("SECOND"), ts)
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * F.lit(86_400_000_000)
        + F.hour(ts).cast("bigint") * F.lit(3_600_000_000)
        + F.minute(ts).cast("bigint") * F.lit(60_000_000)
        + (seconds * F.lit(1_000_000)).cast("bigint")
    )


def micros_of(frame: DataFrame, name: str) -> Column:
    """Microseconds of a time column of either kind; one without zone is read as UTC."""
    return ntz_micros(F.col(name)) if dict(frame.dtypes)[name] == "timestamp_ntz" else F.unix_micros(name)


def micros_ntz(micros: Column) -> Column:
    """The UTC wall clock (timestamp without zone) of epoch microseconds."""
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))


def interval_micros(interval: Column) -> Column:
    """Microseconds of a day-to-second interval."""
    return (
        F.extract(F.lit("DAY"), interval).cast("bigint") * F.lit(86_400_000_000)
        + F.extract(F.lit("HOUR"), interval).cast("bigint") * F.lit(3_600_000_000)
        + F.extract(F.lit("MINUTE"), interval).cast("bigint") * F.lit(60_000_000)
        + (F.extract(F.lit("SECOND"), interval) * F.lit(1_000_000)).cast("bigint")
    )


def instant(ts: Column) -> Column:
    """The instant of a timestamp without zone that is read as UTC."""
    return F.timestamp_micros(ntz_micros(ts))


def utc_wall(ts: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session zone is."""
    return micros_ntz(F.unix_micros(ts))


def parse_utc(text: Column, naive_zone: str = LAKE_ZONE) -> Column:
    """Event text to its UTC wall clock; null when it cannot be read.

    Devices send `...Z`, which needs one cast and no zone lookup. Text with
    another zone goes through the instant; all other text is local time of
    `naive_zone`. A time of day without a date names no instant.
    """
    wall = text.try_cast("timestamp_ntz")
    zoned = utc_wall(text.try_cast("timestamp"))
    dated = ~text.rlike(_NO_DATE)
    return (
        F.when(text.endswith("Z"), F.coalesce(wall, F.when(dated, zoned)))
        .when(text.rlike(_ZONED), F.when(dated, zoned))
        .otherwise(F.convert_timezone(F.lit(naive_zone), F.lit("UTC"), wall))
    )


def hour_of_time(text: Column) -> Column:
    """The hour of text that is a time of day without date or zone; null for other text."""
    hour = F.regexp_extract(text, _TIME_ONLY, 1).try_cast("int")
    return F.when(hour < 24, hour)


def event_date(text: Column) -> Column:
    """The date as written in the text: the UTC date of a `...Z` event."""
    return text.try_cast("date")


def hour_in(utc: Column, zone: str = LAKE_ZONE) -> Column:
    """The hour of day in `zone` of a UTC wall clock."""
    shiftable = utc > F.lit(_FIRST_SHIFTABLE).cast("timestamp_ntz")
    return F.hour(F.when(shiftable, F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)))
