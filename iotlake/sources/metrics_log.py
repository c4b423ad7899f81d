"""Reader of the producer window log."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from iotlake.schemas import METRICS_LOG

_PARTITIONED = T.StructType(METRICS_LOG.fields + [
    T.StructField("run", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("topic", T.StringType()),
])


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """Log rows of all runs, with their `run`, `batch` and `topic`."""
    return spark.read.schema(_PARTITIONED).option("header", True).csv(path)
