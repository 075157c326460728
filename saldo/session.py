"""Spark session with the settings the jobs are tuned for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Hot join keys are split at run time, whatever runs after the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A sort-merge join whose partitions all turn out small becomes a hash join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}

# A shuffle starts with this many partitions, which are merged as they turn out small: Spark's
# 200 would be an upper limit, half a terabyte each at 100 TB. Local sessions keep their own.
CLUSTER_SETTINGS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000"}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with SETTINGS, on a cluster CLUSTER_SETTINGS too; `conf` keys use `__` for dots and win over SETTINGS."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {k.replace("__", "."): v for k, v in conf.items()}
    cluster = {} if (master or "").startswith("local") else CLUSTER_SETTINGS
    for key, value in {**SETTINGS, **cluster, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
