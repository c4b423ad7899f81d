"""Envelopes stored as Parquet, read as a batch or replayed as a stream."""

from pyspark.sql import DataFrame, SparkSession

from iotlake.schemas import ENVELOPE


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).parquet(path)


def replay(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
