"""Reports over partitions, files and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.functions.hashing import stable_number
from brookmill.functions.text import readable_size


def partition_report(stored: DataFrame, by: list[str]) -> DataFrame:
    """Files and rows of each partition of a stored table."""
    files = (
        stored.select(*by, F.col("_metadata.file_path").alias("f"))
        .groupBy(*by, "f")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return files.groupBy(*by).agg(F.count(F.lit(1)).alias("parts_count"), F.sum("n").alias("total_rows"))


def shard_report(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Rows per hash shard of ``key``, with the share of the heaviest key in it.

    Keys are counted before shards, so the report itself does not suffer from
    the skew it looks for.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).withColumn("shard", (stable_number(key) % shards).cast("int"))
    return per_key.groupBy("shard").agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("keys"), F.max("n").alias("heaviest_key")
    )


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, files and bytes of stored tables."""
    out = None
    for name, df in tables.items():
        files = df.select(
            F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")
        ).groupBy("f", "b").agg(F.count(F.lit(1)).alias("n"))
        one = files.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("b"), F.lit(0)).alias("total_bytes"),
        ).select(F.lit(name).alias("table"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def heaviest(df: DataFrame, weight: str, n: int, tie: list[Column | str], text: str | None = None) -> DataFrame:
    """Top ``n`` log entries by ``weight``, with the weight as readable bytes."""
    top = df.orderBy(F.col(weight).desc(), *tie).limit(n).withColumn("memory", readable_size(weight))
    return top.withColumn("preview", F.substring(text, 1, 100)) if text else top
