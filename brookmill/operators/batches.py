"""Statistics of loads and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_stats(df: DataFrame, batch: str, time: str) -> DataFrame:
    """Rows, first and last time and duration in seconds per batch."""
    t = F.unix_timestamp(F.col(time).cast("timestamp"))
    return df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("records_in_batch"),
        F.min(time).alias("batch_start"),
        F.max(time).alias("batch_end"),
        (F.max(t) - F.min(t)).alias("batch_duration_seconds"),
    )


def path_stats(paths: dict[str, DataFrame], key: str, time: str) -> DataFrame:
    """The same row of statistics for several ingestion paths, one under the other."""
    out = None
    for name, df in paths.items():
        one = df.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.countDistinct(key).alias("unique_keys"),
            F.min(time).alias("earliest"),
            F.max(time).alias("latest"),
        ).select(F.lit(name).alias("method"), "*")
        out = one if out is None else out.unionByName(one)
    return out
