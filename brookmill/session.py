"""Session settings for jobs that start their own Spark session.

A library function never changes the settings of a session it is given; these
are the values the package is tuned for and what tests and ``bench.py`` use.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: small shuffle partitions are merged, skewed join
    # partitions are split even when the split costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Stream state on disk and not in the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Batches for Python functions end at so many bytes, whatever their rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    # Filters reach data sources written in Python.
    "spark.sql.python.filterPushdown.enabled": "true",
}


def build_session(
    master: str | None = None,
    app: str = "brookmill",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with :data:`SETTINGS`.

    ``shuffle_partitions`` is the starting count that adaptive execution merges
    down from. On a cluster give about three times the executor cores, or more
    where a shuffle carries over 200 MB for each of them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
