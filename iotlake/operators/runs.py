"""Values carried from row to row of a series, without ordering a whole series in one task."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from iotlake.functions.event_time import interval_micros, micros_of


def run_number(frame: DataFrame, order: str, width: str, length: int) -> Column:
    """The number of the run that a row's time is in: `length` times `width` long."""
    span = interval_micros(F.expr(f"INTERVAL {width}").cast("interval day to second")) * length
    return F.floor(micros_of(frame, order) / span)


def with_previous(rows: DataFrame, keys: Iterable[str], order: str, run: str, value: str) -> DataFrame:
    """Add `previous`: `value` of the row before, of the same keys, by `order`; null at a key's first row.

    Rows are ordered within a key and `run`, a whole number that never falls as `order` rises; only the first row of each run is
    ordered by key, and gets the last value of the run before. So a long series is spread over its runs, nothing is joined, and
    both parts read one and the same exchange.
    """
    keys = list(keys)
    inside = Window.partitionBy(*keys, run).orderBy(order)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = rows.withColumns({
        "_within": F.lag(value).over(inside), "_later": F.lag(F.lit(True)).over(inside), "_last": F.last(value).over(whole)})
    later = marked.where("_later").select(*rows.columns, F.col("_within").alias("previous"))
    first = marked.where("_later IS NULL").select(
        *rows.columns, F.lag("_last").over(Window.partitionBy(*keys).orderBy(run)).alias("previous"))
    return later.unionAll(first)
