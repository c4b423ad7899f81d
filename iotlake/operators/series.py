"""Queries over metric samples (`ts, metric, labels, value`)."""

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from iotlake.functions.event_time import micros_of
from iotlake.functions.labels import label, label_equals, label_matches
from iotlake.operators.runs import run_number, with_previous

# The producer jobs, their targets, and the labels that a job adds to its samples.
TARGETS = {
    "kafka-producer-json": (["host.docker.internal:9108"], {}),
    "kafka-producer-parq": (["host.docker.internal:9109"], {}),
    "kafka-producer-json-ckafka": (["host.docker.internal:9118"], {"impl": "ckafka"}),
    "kafka-producer-parq-ckafka": (["host.docker.internal:9119"], {"impl": "ckafka"}),
    "kafka-producers-kpython": (["localhost:9108", "localhost:9109"], {"impl": "kpython"}),
    "kafka-producers-ckafka": (["localhost:9118", "localhost:9119"], {"impl": "ckafka"}),
}


def select_series(samples: DataFrame, metric: str | None = None,
                  equals: Mapping[str, str] | None = None,
                  matches: Mapping[str, str] | None = None) -> DataFrame:
    """Samples of a metric whose labels equal, or match as a whole, the given ones."""
    if metric is not None:
        samples = samples.where(F.col("metric") == metric)
    for name, value in (equals or {}).items():
        samples = samples.where(label_equals(name, value))
    for name, pattern in (matches or {}).items():
        samples = samples.where(label_matches(name, pattern))
    return samples


def time_range(samples: DataFrame, end: datetime | Column | str, minutes: float = 15) -> DataFrame:
    """Samples in the `minutes` up to and including `end`; pushed to the scan."""
    if not isinstance(end, Column):
        end = F.lit(str(end)).cast(samples.schema["ts"].dataType)
    length = F.make_dt_interval(secs=F.lit(60 * minutes).cast("decimal(18,6)"))
    return samples.where((F.col("ts") > end - length) & (F.col("ts") <= end))


def per_step(samples: DataFrame, step: str, tie: str | None = None,
             watermark: str | None = None) -> DataFrame:
    """The last sample of every series in every step of `step` length.

    Empty steps stay empty; `window` is the step with its end. A series has one sample per instant; where that is
    not given, `tie` names a whole-number column that decides. Time and tie are
    packed into one decimal, as that is a fixed-width value: the aggregate then
    hashes in place, where a struct would have every task sort all its samples.
    """
    if watermark:
        samples = samples.withWatermark("ts", watermark)
    order = F.col("ts")
    if tie:
        order = (
            micros_of(samples, "ts").cast("decimal(19,0)") * F.lit("20000000000000000000").cast("decimal(20,0)")
            + F.col(tie).cast("decimal(19,0)")
        )
    return (
        samples.groupBy(F.window("ts", step), "metric", "labels")
        .agg(F.max_by("value", order).alias("value"))
        .select("window", F.col("window.start").alias("step"), "metric", "labels", "value")
    )


def sum_by(stepped: DataFrame, *names: str, scale: int | None = None) -> DataFrame:
    """Sum over series per step, grouped by the named labels; missing is ''.

    The input holds one sample per series and step, as `per_step` gives it. With
    `scale` the sum is taken in decimals of that scale, so its last digits do
    not depend on the order tasks finish in.
    """
    value = F.col("value")
    if scale is not None:
        value = value.cast(f"decimal({18 + scale},{scale})")
    summed = stepped.groupBy("window", *[label(n).alias(n) for n in names]).agg(
        F.sum(value).cast("double").alias("total")
    )
    return summed.select(F.col("window.start").alias("step"), *names, "total")


def label_values(samples: DataFrame, metric: str, *names: str,
                 targets: Mapping[str, tuple[Sequence[str], Mapping[str, str]]] | None = None) -> DataFrame:
    """`label, value`: the distinct non-empty values of the labels on a metric, in one pass.

    With `targets` the samples are as scraped, with the columns job and instance, and the values are those that `with_listed_targets` would add;
    only the asked labels are looked at, and no map is built.
    """
    value = label if targets is None else lambda name: _listed_label(name, targets)
    pairs = F.array(*[F.struct(F.lit(name).alias("label"), value(name).alias("value")) for name in names])
    return select_series(samples, metric).select(F.inline(pairs)).where("value <> ''").distinct()


def _listed_label(name: str, targets: Mapping[str, tuple[Sequence[str], Mapping[str, str]]]) -> Column:
    """The value of one label after the listed targets have been added."""
    found = label(name)
    for job, (instances, labels) in targets.items():
        added = {"job": F.lit(job), "instance": F.col("instance"), **{k: F.lit(v) for k, v in labels.items()}}
        own = name.removeprefix("exported_")
        here = added.get(name)
        if here is None and own != name and own in added:
            # What the target's own label has replaced.
            here = F.coalesce(F.try_element_at("labels", F.lit(own)), label(name))
        if here is not None:
            found = F.when((F.col("job") == job) & F.col("instance").isin(*instances), here).otherwise(found)
    return found


def with_display_name(samples: DataFrame, name: str) -> DataFrame:
    """Add `series`, the legend text: the value of one label."""
    return samples.withColumn("series", label(name))


def with_labels(labels: Column, added: Column) -> Column:
    """Add labels; where a name is taken, the sample's own becomes `exported_<name>`."""
    renamed = F.transform_keys(
        labels,
        lambda k, _: F.when(F.map_contains_key(added, k), F.concat(F.lit("exported_"), k)).otherwise(k),
    )
    return F.map_concat(renamed, added)


def with_listed_targets(
    samples: DataFrame, targets: Mapping[str, tuple[Sequence[str], Mapping[str, str]]] = TARGETS,
) -> DataFrame:
    """Add `job`, `instance` and the target's labels to samples that carry the columns job and instance.

    `targets` lists each job's instances and labels. A list is part of the expression, so nothing is
    joined or shuffled. A sample of a target that isn't listed stays as it is.
    """
    added = F.create_map().cast("map<string,string>")
    for job, (instances, labels) in targets.items():
        pairs = [F.lit(x) for pair in {"job": job, **labels}.items() for x in pair]
        here = F.create_map(*pairs, F.lit("instance"), F.col("instance"))
        added = F.when((F.col("job") == job) & F.col("instance").isin(*instances), here).otherwise(added)
    return samples.withColumn("labels", with_labels(F.col("labels"), added))


def with_target_labels(samples: DataFrame, targets: DataFrame, on: Iterable[str] = ("job",)) -> DataFrame:
    """Add the labels of each sample's target, from a stored table (`*on, target_labels map`).

    Left join without a hint: Spark broadcasts the table while its size in storage is below the broadcast
    threshold, and shuffles beyond it. For a fixed list use `with_listed_targets`.
    """
    none = F.create_map().cast("map<string,string>")
    joined = samples.join(targets, list(on), "left")
    added = F.coalesce("target_labels", none)
    return joined.withColumn("labels", with_labels(F.col("labels"), added)).drop("target_labels")


def per_type(samples: DataFrame, step: str, types: Column, scale: int | None = None) -> DataFrame:
    """`step, metric, labels, type, value`: a step's last value of a GAUGE, and the increase of a COUNTER over it.

    `types` gives a sample's type: COUNTER, or anything else for a gauge. A series has one sample per instant.
    """
    typed = samples.withColumn("type", types)
    counter = F.col("type") == "COUNTER"
    last = (
        typed.where(~F.coalesce(counter, F.lit(False)))
        .groupBy(F.window("ts", step), "metric", "labels", "type").agg(F.max_by("value", "ts").alias("value"))
        .select(F.col("window.start").alias("step"), "metric", "labels", "type", "value")
    )
    grown = increase(typed.where(counter), step, scale=scale)
    return last.unionByName(grown.select("step", "metric", "labels", F.lit("COUNTER").alias("type"), "value"))


def increase(samples: DataFrame, step: str, scale: int | None = None, run: int = 10_000) -> DataFrame:
    """`step, metric, labels, value`: what the counters have counted in each step that has a sample of theirs.

    Each sample adds its difference to the series' sample before it, of whatever step; after a fall, which is a restart from
    zero, it adds its own value. A series' first sample adds nothing. Samples without a value count for nothing. Samples are ordered within a
    series and step; the last value of a step is handed on to the next within runs of `run` steps, and from run to run.
    With `scale` differences and sums are taken in decimals of that scale, so the last digits don't depend on an order.
    """
    value = F.col("value") if scale is None else F.col("value").cast(f"decimal({18 + scale},{scale})")
    # A map can't be ordered or partitioned by; its sorted entries can.
    known = samples.where(F.col("value").isNotNull()).select(
        F.window("ts", step)["start"].alias("step"), "metric", F.array_sort(F.map_entries("labels")).alias("_series"), "ts", value.alias("value"))
    keys = ["metric", "_series"]
    before = F.lag("value").over(Window.partitionBy(*keys, "step").orderBy("ts", "value"))
    grown = known.withColumn("_grown", _growth(F.col("value"), before))
    steps = grown.groupBy(*keys, "step").agg(
        F.min_by("value", "ts").alias("first"), F.max_by("value", "ts").alias("last"), F.sum("_grown").alias("within"))
    steps = steps.withColumn("_run", run_number(steps, "step", step, run))
    carried = with_previous(steps, keys, "step", "_run", "last")
    total = F.coalesce("within", F.lit(0)) + F.coalesce(_growth(F.col("first"), F.col("previous")), F.lit(0))
    return carried.select("step", "metric", F.map_from_entries("_series").alias("labels"), total.cast("double").alias("value"))


def _growth(value: Column, before: Column) -> Column:
    """What a counter has counted since the sample before it; null without one."""
    return F.when(value >= before, value - before).when(before.isNotNull(), value)
