"""Removal of records that were already seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmill.functions.hashing import row_digest


def drop_repeats(df: DataFrame, columns: list[str] | None = None, digest: str = "record_hash") -> DataFrame:
    """Batch form: one row per record content. Only digest and row travel; repeats
    are removed before the shuffle."""
    return df.withColumn(digest, row_digest(*(columns or df.columns))).dropDuplicates([digest])


def drop_repeats_stream(
    df: DataFrame, ts: str, columns: list[str] | None = None, memory: str = "7 days", digest: str = "record_hash"
) -> DataFrame:
    """Stream form: remembers digests for ``memory`` of event time, so state stays bounded.

    Copies are first dropped per input task, then overall. A record that comes
    very often therefore reaches the second step at most once per task instead
    of meeting all its copies in one.
    """
    timed = df.withColumn(digest, row_digest(*(columns or df.columns)))
    timed = timed.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, memory)
    per_task = timed.withColumn("__task", F.spark_partition_id()).dropDuplicatesWithinWatermark([digest, "__task"])
    return per_task.drop("__task").dropDuplicatesWithinWatermark([digest])
