"""Lake reader: the declared schema, partition pruning, event-time ranges."""

from datetime import date as Date
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from iotlake.functions.event_time import LAKE_ZONE, parse_utc
from iotlake.schemas import LAKE


def read_lake(spark: SparkSession, path: str, fmt: str, date: Date | str | None = None,
              hour: int | None = None) -> DataFrame:
    """Lake rows, optionally of one date and hour.

    The schema is always given: inference would widen integers, reorder JSON
    columns and cost a pass over the data. Both filters prune directories.
    """
    rows = spark.read.schema(LAKE).format(fmt).load(path)
    if date is not None:
        rows = rows.where(F.col("date") == F.lit(date).cast("date"))
    if hour is not None:
        rows = rows.where(F.col("hour") == F.lit(hour))
    return rows


def _utc(moment: datetime) -> datetime:
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def read_lake_between(spark: SparkSession, path: str, fmt: str, start: datetime, end: datetime,
                      naive_zone: str = LAKE_ZONE) -> DataFrame:
    """Lake rows whose event instant lies in [start, end); naive bounds are UTC.

    `date` is the date as the device wrote it, which is at most one day from
    the UTC date, so one day on each side is read: directories are pruned by that and rows
    are then kept by their parsed instant. `hour` is local and prunes nothing.
    """
    low, high = _utc(start), _utc(end)
    rows = read_lake(spark, path, fmt).where(
        F.col("date").between(
            F.date_sub(F.lit(low.date()), 1), F.date_add(F.lit(high.date()), 1)
        )
    )
    at = parse_utc(F.col("timestamp"), naive_zone)
    as_ntz = lambda moment: F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    return rows.where((at >= as_ntz(low)) & (at < as_ntz(high)))
