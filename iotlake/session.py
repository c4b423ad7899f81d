"""Session settings for a cluster run."""

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Adaptive execution splits skewed joins and rebalanced partitions and merges
# small ones; the RocksDB store keeps large streaming state off the JVM heap.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def object_store_conf(
    endpoint: str | None = None,
    path_style: bool = True,
    access_key: str | None = None,
    secret_key: str | None = None,
) -> dict[str, str]:
    """S3A settings. Keys are optional: without them the provider chain decides."""
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if bool(access_key) != bool(secret_key):
        raise ValueError("give both the access key and the secret key, or neither")
    if access_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def session(app_name: str, conf: Mapping[str, str] | None = None) -> SparkSession:
    """A session with the defaults above; `conf` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
