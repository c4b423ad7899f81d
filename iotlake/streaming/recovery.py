"""Start-up checks of sinks against their checkpoints, and the folders of sinks that write one for each batch."""

import re

from pyspark.sql import SparkSession

from iotlake.sources.checkpoint import folder_names, last_batch


class CheckpointMismatch(RuntimeError):
    """The sink already holds batches the checkpoint does not know."""


def check_recovery(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse to start a file sink whose checkpoint was lost or replaced.

    The sink's log survives with the output. A fresh checkpoint counts batches
    from zero, and the sink skips, without an error, every batch id it already
    has: those rows would be lost.
    """
    written = last_batch(spark, f"{path}/_spark_metadata")
    if written is None:
        return
    planned = last_batch(spark, f"{checkpoint}/offsets")
    if planned is None or planned < written:
        raise CheckpointMismatch(
            f"{path} holds batch {written}, but checkpoint {checkpoint} "
            f"{'is empty' if planned is None else f'ends at batch {planned}'}; new rows would be "
            "skipped. Restore the checkpoint or write to a new path."
        )


def _batches(names: list[str]) -> list[int]:
    return sorted(int(found[1]) for found in (re.fullmatch(r"batch=(\d+)", name) for name in names) if found)


def whole_batches(spark: SparkSession, path: str) -> list[int]:
    """The ids of a folder's `batch=<id>` tables that were written to their end, ascending."""
    return [n for n in _batches(folder_names(spark, path)) if "_SUCCESS" in folder_names(spark, f"{path}/batch={n}")]


def check_batches(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse to start a sink that writes `batch=<id>` folders if its checkpoint was lost or replaced.

    A fresh checkpoint counts batches from zero, and its batches would replace those that are there.
    """
    written = _batches(folder_names(spark, path))
    planned = last_batch(spark, f"{checkpoint}/offsets")
    if written and (planned is None or planned < written[-1]):
        raise CheckpointMismatch(
            f"{path} holds batch {written[-1]}, but checkpoint {checkpoint} "
            f"{'is empty' if planned is None else f'ends at batch {planned}'}; new batches would replace "
            "old ones. Restore the checkpoint or write to a new path."
        )


def drop_batch(spark: SparkSession, path: str, batch: int) -> None:
    """Delete a table that newer ones have replaced."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={batch}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
