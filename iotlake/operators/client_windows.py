"""Metric windows as a client opens them: each starts at the message that closed the one before."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from iotlake.functions.event_time import interval_micros, micros_ntz, micros_of
from iotlake.operators.runs import with_previous
from iotlake.scratch import stored

#: Slots of a block, and blocks of a block of the next level.
BLOCK = 4


def client_windows(deliveries: DataFrame, keys: Iterable[str] = ("topic", "client_id"), width: str = "10 seconds",
                   tie: str | None = None, run: int = 10_000) -> DataFrame:
    """Count, rate, errors, failed sends and mean planned delay of each window of each client (batch only).

    A client's first window opens at its first message. A window closes at the first message that comes at least `width` after it
    opened, counts that message, lasts until it, and the next opens there; `tie`, a whole number, orders messages of one
    instant. The last, still open window of a client is not reported. Rows without a time count for nothing.

    No client is walked through in one task. Times are cut into slots of `width`, so the instant that would close a window opened at an instant t is the
    first one from t + width on in the next slot, or else the first one of the slots behind it. Such jumps are joined to jumps out of blocks of 4, 16, 64, ... slots,
    each only for the instants at which a jump enters such a block. From a client's first instant the longest jumps give the starts that are
    first in their block, and the shorter ones those between. So every instant is gone through at one level alone, and the levels above it have
    an eighth of them and less. A window's messages lie in the slot of its start and the next one, and a slot has one start at most, so messages find their window by an equal join.
    """
    keys = list(keys)
    span = F.lit(interval_micros(F.expr(f"INTERVAL {width}").cast("interval day to second")))
    naive = dict(deliveries.dtypes)["ts"] == "timestamp_ntz"
    order = F.col(tie) if tie else F.lit(0)
    error, delay = (F.col("status") == "error").cast("int"), F.coalesce("planned_delay", F.lit(0.0))
    instants = stored(
        deliveries.where("ts IS NOT NULL")
        .select(*keys, micros_of(deliveries, "ts").alias("t"), error.alias("e"), delay.alias("d"), order.alias("o"))
        .groupBy(*keys, "t").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("e", F.lit(0))).alias("errors"), F.sum("d").alias("delay"),
            F.coalesce(F.min_by("e", "o"), F.lit(0)).alias("first_error"), F.min_by("d", "o").alias("first_delay"))
        .withColumn("slot", F.floor(F.col("t") / span)), "instants")

    # A window by the slots that its messages may lie in; the closing message is that of the instant `end`.
    opened = _starts(_closing(instants, keys, span, run), keys, span).where("end IS NOT NULL")
    slot = F.floor(F.col("start") / span)
    reach = opened.select(*[F.col(k).alias(f"_{k}") for k in keys], "start", "end", F.explode(F.array(slot, slot + 1)).alias("_slot"))
    inside = instants.join(reach, _same(keys) & (F.col("slot") == F.col("_slot"))).where(
        (F.col("t") >= F.col("start")) & (F.col("t") < F.col("end"))).select(*instants.columns, "start", "end")
    first = instants.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("t").alias("_begin"))
    # The message that opened a window was counted by the window before, but for the very first one.
    again = (F.col("t") == F.col("start")) & (F.col("t") > F.col("_begin"))
    less = lambda whole, one: F.col(whole) - F.when(again, F.col(one)).otherwise(0)
    own = inside.join(first, _same(keys)).select(
        *keys, "start", "end", (F.col("n") - again.cast("int")).alias("n"), less("errors", "first_error").alias("errors"),
        less("delay", "first_delay").alias("delay"))
    closing = instants.join(
        opened.select(*[F.col(k).alias(f"_{k}") for k in keys], "start", "end"), _same(keys) & (F.col("t") == F.col("end"))
    ).select(*keys, "start", "end", F.lit(1).alias("n"), F.col("first_error").alias("errors"), F.col("first_delay").alias("delay"))

    summed = own.unionByName(closing).groupBy(*keys, "start", "end").agg(
        F.sum("n").alias("msg_count"), F.sum("errors").alias("error_count"), F.sum("delay").alias("delay"))
    seconds = (F.col("end") - F.col("start")) / F.lit(1e6)
    time = micros_ntz if naive else F.timestamp_micros
    return summed.select(
        *keys, time(F.col("start")).alias("window_start"), time(F.col("end")).alias("window_end"), "msg_count",
        (F.col("msg_count") / seconds).alias("rate"), "error_count", (F.col("error_count") / seconds).alias("error_rate"),
        (F.col("delay") / F.col("msg_count")).alias("avg_delay"))


def _same(keys: list[str]) -> Column:
    """Null-safe, so that messages of a missing key are kept."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def _closing(instants: DataFrame, keys: list[str], span: Column, run: int) -> DataFrame:
    """`*keys, start, end`: for every instant the one that would close a window opened at it; null if there is none."""
    # Per slot the first instant of the next slot that has any: slots backwards, so that it is the row before.
    slots = instants.groupBy(*keys, "slot").agg(F.min("t").alias("first")).select(
        *keys, (-F.col("slot")).alias("back"), F.floor(-F.col("slot") / run).alias("_run"), "first")
    beyond = with_previous(slots, keys, "back", "_run", "first").select(
        *[F.col(k).alias(f"_{k}") for k in keys], (-F.col("back")).alias("_slot"), F.col("previous").alias("beyond"))
    known = instants.select(*keys, "t", "slot").join(beyond, _same(keys) & (F.col("slot") == F.col("_slot"))).select(
        *keys, "t", "slot", "beyond")
    # Each slot's instants, and what is asked of it by the slot before: the next instant at or after a time.
    there = known.select(*keys, "slot", F.col("t").alias("at"), F.lit(1).alias("is_instant"), "beyond", F.lit(None).cast("long").alias("start"))
    asked = known.select(*keys, (F.col("slot") + 1).alias("slot"), (F.col("t") + span).alias("at"), F.lit(0).alias("is_instant"),
                         "beyond", F.col("t").alias("start"))
    here = Window.partitionBy(*keys, "slot")
    latest_first = here.orderBy(F.desc("at"), F.desc("is_instant")).rowsBetween(Window.unboundedPreceding, 0)
    hit = F.last(F.when(F.col("is_instant") == 1, F.col("at")), ignorenulls=True).over(latest_first)
    some = F.max("is_instant").over(here) == 1
    after = F.max(F.when(F.col("is_instant") == 1, F.col("beyond"))).over(here)
    end = F.coalesce(hit, F.when(some, after).otherwise(F.col("beyond")))
    return there.unionByName(asked).withColumn("end", end).where("is_instant = 0").select(*keys, "start", "end")


def _starts(closing: DataFrame, keys: list[str], span: Column) -> DataFrame:
    """`*keys, start, end` of the windows that follow one another from each key's first instant."""
    closing = stored(closing, "window-jumps")
    slot = lambda c: F.floor(F.col(c) / span)
    low, high = closing.agg(F.min(slot("start")), F.max(slot("start"))).first()
    if low is None:
        return closing
    # A block of level k is BLOCK ** k slots.
    block = lambda c, level: F.floor((slot(c) - low) / BLOCK ** level)
    levels = 1
    while BLOCK ** levels <= high - low:
        levels += 1

    def follow(state, jumps, level):
        """Moves `here` by the jumps of a level until it is beyond its block of the next level: that has `BLOCK` blocks, and no jump stays in one."""
        state = state.withColumn("_block", block("here", level + 1))
        for k in range(BLOCK):
            step = jumps.where(block("start", level) % BLOCK == k).select(
                *[F.col(c).alias(f"_{c}") for c in keys], F.col("start").alias("_start"), F.col("end").alias("_end"),
                block("start", level + 1).alias("_there"))
            met = F.col("_start").isNotNull()
            state = state.join(
                step, _same(keys) & (F.col("here") == F.col("_start")) & (F.col("_block") == F.col("_there")), "left"
            ).withColumns({"here": F.when(met, F.col("_end")).otherwise(F.col("here")), "path": F.when(
                met, F.concat("path", F.array(F.struct(F.col("_start").alias("start"), F.col("_end").alias("end"))))).otherwise(F.col("path"))}
            ).drop(*step.columns)
        return state

    none = F.array().cast("array<struct<start:long,end:long>>")
    first = stored(closing.groupBy(*keys).agg(F.min("start").alias("start")), "window-first")
    jumps = [closing]
    for level in range(levels - 1):
        entered = jumps[-1].where(block("start", level + 1) != block("end", level + 1)).select(*keys, F.col("end").alias("start")).distinct()
        entered = entered.unionByName(first).withColumns({"here": F.col("start"), "path": none})
        jumps.append(stored(follow(entered, jumps[-1], level).select(*keys, "start", F.col("here").alias("end")), "window-jumps"))
    found = first
    for level in reversed(range(levels)):
        met = follow(found.select(*keys, F.col("start").alias("here"), none.alias("path")), jumps[level], level)
        found = stored(met.select(*keys, F.inline("path")), "window-starts")
    return found
