"""Declared schemas of every table the operators read or write."""

from pyspark.sql import types as T

# Message envelope: the seven columns the topic connector produces.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

# Device event carried as JSON text in the envelope value. `timestamp` stays
# text on purpose: the lake keeps what the device sent.
EVENT = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("battery_level", T.IntegerType()),
    T.StructField("motion_detected", T.BooleanType()),
    T.StructField("timestamp", T.StringType()),
])

PARTITION_COLUMNS = ("date", "hour")

# Lake row: the event plus its partition columns.
LAKE = T.StructType(EVENT.fields + [
    T.StructField("date", T.DateType()),
    T.StructField("hour", T.IntegerType()),
])

# One delivery attempt of a producer.
DELIVERY = T.StructType([
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("topic", T.StringType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("planned_delay", T.DoubleType()),
    T.StructField("status", T.StringType()),
])

# One sample of one time series.
SAMPLE = T.StructType([
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("metric", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("value", T.DoubleType()),
])

# Producer window log, as written to CSV (`topic` is the partition column).
METRICS_LOG = T.StructType([
    T.StructField("elapsed_seconds", T.DoubleType()),
    T.StructField("rate", T.DoubleType()),
    T.StructField("msg_count", T.LongType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("dropped_count", T.LongType()),
    T.StructField("avg_delay", T.DoubleType()),
])

# Committed offsets of one streaming query.
COMMITTED = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("committed", T.LongType()),
])

# Per-batch rates of a streaming query.
PROGRESS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("batchId", T.LongType()),
    T.StructField("numInputRows", T.LongType()),
    T.StructField("inputRowsPerSecond", T.DoubleType()),
    T.StructField("processedRowsPerSecond", T.DoubleType()),
])
