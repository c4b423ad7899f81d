"""The completeness report: topics, offsets, batches, files and lag of a stored or running system.

`python -m iotlake.plans.report --servers ... --out PATH --lake json=PATH --checkpoint NAME=PATH`

Every table of the report is written in full under `--out`; what is printed is named as a summary. Topics are
read once, from `--starting` to their end; with a checkpoint the default is what its query has committed, and a partition
without newer messages then ends where that does.
"""

import argparse
import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from iotlake.operators import monitor
from iotlake.session import object_store_conf, session
from iotlake.sources.lake import read_lake
from iotlake.sources.topic import read_topic_range


def report(spark: SparkSession, envelopes: DataFrame, lakes: Mapping[str, str],
           checkpoints: Mapping[str, str]) -> dict[str, DataFrame]:
    """One DataFrame per check; `lakes` maps format to path, `checkpoints` query name to path."""
    ends = monitor.end_offsets(envelopes)
    if checkpoints:
        # Partitions without a message in the range read end where they were committed.
        reached = _reached(spark, checkpoints)
        ends = ends.unionByName(reached.select("topic", "partition", F.col("committed").alias("end_offset"))).where(
            "end_offset IS NOT NULL").groupBy("topic", "partition").agg(F.max("end_offset").alias("end_offset"))
    parts = {"topics": monitor.describe_topics(envelopes), "end offsets": ends}
    if checkpoints:
        parts["lag"] = monitor.consumer_lag(ends, reached)
    for query, path in checkpoints.items():
        parts[f"newest batches of {query}"] = monitor.recent_batches(spark, path)
    for fmt, path in lakes.items():
        parts[f"newest {fmt} files"] = monitor.newest_files(spark, path)
        parts[f"{fmt} rows"] = monitor.partition_counts(read_lake(spark, path, fmt))
    return parts


def _reached(spark: SparkSession, checkpoints: Mapping[str, str]) -> DataFrame:
    """topic, partition, committed: how far the queries got."""
    committed = reduce(DataFrame.unionByName, [
        monitor.committed_offsets(spark, path, query) for query, path in checkpoints.items()])
    return committed.groupBy("topic", "partition").agg(F.max("committed").alias("committed"))


def starting_offsets(spark: SparkSession, checkpoints: Mapping[str, str]) -> str:
    """Where to read from to see what is left: committed offsets as JSON; a topic never committed is not named.

    A number per partition reaches the driver.
    """
    offsets: dict[str, dict[str, int]] = {}
    for row in _reached(spark, checkpoints).where("committed IS NOT NULL").collect():
        offsets.setdefault(row.topic, {})[str(row.partition)] = row.committed
    return json.dumps(offsets) if offsets else "earliest"


def summaries(parts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """One row per part: its number of rows, and for the lag also the sum and the worst partition."""
    found = {title: frame.agg(F.count(F.lit(1)).alias("rows")) for title, frame in parts.items()}
    if "lag" in parts:
        found["lag"] = parts["lag"].agg(
            F.count(F.lit(1)).alias("rows"), F.sum("lag").alias("total_lag"),
            F.max_by(F.struct("topic", "partition", "lag"), "lag").alias("worst"))
    return found


def _pairs(values: Sequence[str]) -> dict[str, str]:
    return dict(value.split("=", 1) for value in values)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="iotlake.plans.report")
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topics", default="topic-json,topic-parq", help="comma-separated")
    parser.add_argument("--starting", help="earliest or offsets as JSON; default: what the checkpoints have committed")
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--out", required=True, help="folder for the tables")
    parser.add_argument("--lake", action="append", default=[], metavar="FORMAT=PATH")
    parser.add_argument("--checkpoint", action="append", default=[], metavar="QUERY=PATH")
    parser.add_argument("--endpoint", help="object store endpoint")
    args = parser.parse_args(argv)
    spark = session("iotlake-report", object_store_conf(args.endpoint) if args.endpoint else None)
    checkpoints = _pairs(args.checkpoint)
    starting = args.starting or (starting_offsets(spark, checkpoints) if checkpoints else "earliest")
    envelopes = read_topic_range(spark, args.servers, args.topics, starting, min_partitions=args.min_partitions)
    # Three parts look at the topics; they are read once.
    seen = f"{args.out}/offsets"
    envelopes.groupBy("topic", "partition").agg(F.max("offset").alias("offset")).write.parquet(seen)
    written = {}
    for title, frame in report(spark, spark.read.parquet(seen), _pairs(args.lake), checkpoints).items():
        path = f"{args.out}/{title.replace(' ', '-')}"
        frame.write.parquet(path)
        written[title] = spark.read.schema(frame.schema).parquet(path)
    for title, frame in summaries(written).items():
        print(f"\n{title}, summary ({args.out}/{title.replace(' ', '-')})")
        frame.show(truncate=False)


if __name__ == "__main__":
    main()
