"""The deployed jobs: topic to lake, and topic to console.

Run with `python -m iotlake.plans.jobs`, or give `spark-submit` the path of this file; every
address, path and zone is an argument, credentials come from the cluster.
"""

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from iotlake.functions.event_time import LAKE_ZONE
from iotlake.operators.decode import decode, to_text, with_partitions
from iotlake.session import object_store_conf, session
from iotlake.sources.topic import read_topic
from iotlake.streaming.sinks import write_console, write_lake

# Topic, consumer group and query name per lake format, and of the tail.
LAKE_JOBS = {
    "json": ("topic-json", "spark-consumer-json", "topic-json_sink"),
    "parquet": ("topic-parq", "spark-consumer-parq", "topic-parq_sink"),
}
TAIL_TOPIC, TAIL_GROUP = "test-topic", "spark-consumers"

# Consumer metrics settings of the lake jobs.
LAKE_CLIENT = {"metrics.recording.level": "DEBUG", "consumer.metrics.enable": "true"}


def lake_rows(envelopes: DataFrame, zone: str = LAKE_ZONE, keys: str = "lake") -> DataFrame:
    """Decoded events with their partition columns: the body of both lake jobs."""
    return with_partitions(decode(envelopes), zone, keys)


def lake_job(envelopes: DataFrame, fmt: str, path: str, checkpoint: str, zone: str = LAKE_ZONE,
             keys: str = "lake", trigger: Mapping[str, object] | None = None,
             files: int | None = None) -> StreamingQuery:
    return write_lake(lake_rows(envelopes, zone, keys), fmt, path, checkpoint, LAKE_JOBS[fmt][2], trigger, files)


def tail_job(envelopes: DataFrame, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    return write_console(to_text(envelopes), trigger)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="iotlake.plans.jobs")
    parser.add_argument("job", choices=[*LAKE_JOBS, "tail"])
    parser.add_argument("--servers", required=True, help="host:port[,host:port]")
    parser.add_argument("--topic")
    parser.add_argument("--group")
    parser.add_argument("--path", help="lake path (lake jobs)")
    parser.add_argument("--checkpoint", help="checkpoint path, kept as long as the lake (lake jobs)")
    parser.add_argument("--zone", default=LAKE_ZONE)
    parser.add_argument("--keys", choices=["lake", "utc"], default="lake")
    parser.add_argument("--starting", help="latest, earliest or offsets as JSON")
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument("--every", help="trigger interval, such as '1 minute'")
    parser.add_argument("--files", type=int, help="most files per partition and micro-batch")
    parser.add_argument("--once", action="store_true", help="drain what is there and stop")
    parser.add_argument("--endpoint", help="object store endpoint")
    args = parser.parse_args(argv)
    if args.job != "tail" and not (args.path and args.checkpoint):
        parser.error("a lake job needs --path and --checkpoint")
    return args


def _trigger(args: argparse.Namespace) -> dict[str, object] | None:
    if args.once:
        return {"availableNow": True}
    return {"processingTime": args.every} if args.every else None


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = session(f"iotlake-{args.job}", object_store_conf(args.endpoint) if args.endpoint else None)
    shared = dict(min_partitions=args.min_partitions, max_offsets_per_trigger=args.max_offsets_per_trigger)
    if args.job == "tail":
        envelopes = read_topic(spark, args.servers, args.topic or TAIL_TOPIC, args.group or TAIL_GROUP,
                               starting=args.starting or "latest", **shared)
        query = tail_job(envelopes, _trigger(args))
    else:
        topic, group, _ = LAKE_JOBS[args.job]
        envelopes = read_topic(spark, args.servers, args.topic or topic, args.group or group,
                               starting=args.starting, client=LAKE_CLIENT, **shared)
        query = lake_job(envelopes, args.job, args.path, args.checkpoint, args.zone, args.keys, _trigger(args),
                         args.files)
    query.awaitTermination()


if __name__ == "__main__":
    main()
