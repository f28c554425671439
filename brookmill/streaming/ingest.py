"""Run a stream over all that has arrived and store the result."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.operators import tables


def run_available(
    stream: DataFrame, checkpoint: str, per_batch: Callable[[DataFrame, int], None], name: str | None = None
) -> None:
    """Feed everything available to ``per_batch`` and stop. The checkpoint makes a
    second run continue where this one ended."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    writer.foreachBatch(per_batch).start().awaitTermination()


def to_table(stream: DataFrame, path: str, checkpoint: str, by: list[str]) -> None:
    """Append to a partitioned folder. The file sink logs committed files, so
    readers see every row once even after a restart."""
    (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*by)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def to_topic(stream: DataFrame, fmt: str, checkpoint: str, **options: str) -> None:
    """Write (key, value) messages to a topic."""
    (
        stream.writeStream.format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def batch_writer(
    path: str, by: list[str] | None = None, transform: Callable[[DataFrame, int], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that can be replayed: a batch replaces its own ``batch_id`` part."""

    def write(df: DataFrame, batch: int) -> None:
        out = transform(df, batch) if transform else df
        out = out.withColumn("batch_id", F.lit(batch))
        tables.write_partitioned(out, path, ["batch_id", *(by or [])], "replace_partitions")

    return write


def audit_columns(df: DataFrame, batch_id: str, group: str, as_of: dt.datetime | None = None) -> DataFrame:
    """Batch id, source partition and offset, processing time, consumer group and lag.

    ``df`` carries the topic columns partition, offset and timestamp.
    """
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return df.select(
        *[c for c in df.columns if c not in ("partition", "offset", "timestamp")],
        F.lit(batch_id).alias("batch_id"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        now.alias("processing_time"),
        F.lit(group).alias("consumer_group_id"),
        (F.unix_timestamp(now) - F.unix_timestamp(F.col("timestamp").cast("timestamp"))).alias("lag_seconds"),
    )


def ingestion_columns(df: DataFrame, shard: int = 1, replica: int = 1, as_of: dt.datetime | None = None) -> DataFrame:
    """Shard, replica and arrival time of a log row that is passed through."""
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return df.withColumns(
        {"replica_shard": F.lit(shard), "replica_num": F.lit(replica), "ingestion_time": now}
    )


def hourly(df: DataFrame, ts: str, keys: list[str], aggregates: dict[str, Column], late: str = "1 hour") -> DataFrame:
    """Hourly sums of a stream. Rows over ``late`` behind the newest one are dropped;
    an hour comes out once it can no longer change."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    grouped = timed.groupBy(F.window(ts, "1 hour"), *keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return grouped.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), *keys, *aggregates)


def refreshed(read_static: Callable[[], DataFrame], enrich: Callable[[DataFrame, DataFrame], DataFrame]):
    """Batch transform that reads the static side anew for every micro-batch."""

    def transform(df: DataFrame, _: int) -> DataFrame:
        return enrich(df, read_static())

    return transform
