"""Comparisons and data checks that return small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows found in one table only, repeats counted, with the side they are on.

    One grouping over both tables; empty means the tables are equal.
    """
    sides = a.withColumn("__w", F.lit(1)).unionByName(b.withColumn("__w", F.lit(-1)))
    agg = sides.groupBy(*a.columns).agg(F.sum("__w").alias("surplus"))
    return agg.filter("surplus != 0").withColumn(
        "side", F.when(F.col("surplus") > 0, "left").otherwise("right")
    )


def completeness(df: DataFrame, expected: str, sent: str) -> DataFrame:
    """Label each batch: success, partial or failed, with the share that arrived."""
    e, s = F.col(expected), F.col(sent)
    return df.withColumns(
        {
            "validation_status": F.when(s == e, "success").when(s > 0, "partial").otherwise("failed"),
            "success_rate": F.coalesce(F.try_divide(s * 100.0, e), F.lit(0.0)),
        }
    )


def flow_check(df: DataFrame, newest: str) -> DataFrame:
    """Row count, newest value of ``newest`` and whether anything arrived."""
    return df.agg(F.count(F.lit(1)).alias("records"), F.max(newest).alias("newest")).withColumn(
        "flowing", F.col("records") > 0
    )


def require_flow(df: DataFrame, newest: str) -> DataFrame:
    """:func:`flow_check` that raises when the table is empty."""
    report = flow_check(df, newest)
    if not report.first()["flowing"]:
        raise ValueError("no data arrived")
    return report


def validate_load(df: DataFrame, category: str, price: str, shards: int, partition, key: str) -> DataFrame:
    """Load report: total, average, per category, per shard of ``key`` and per partition.

    One pass: every row feeds one cell of (category, shard, partition), and the
    report sections are sums over those few cells.
    """
    from brookmill.functions.hashing import stable_number

    cells = (
        df.withColumns({"__c": F.col(category), "__h": (stable_number(key) % shards).cast("int"), "__p": partition})
        .groupBy("__c", "__h", "__p")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(price).alias("s"), F.count(price).alias("k"))
    )
    items = {"total": F.lit(""), "category": F.col("__c"), "shard": F.col("__h"), "partition": F.col("__p")}
    sections = F.array(
        *[F.struct(F.lit(k).alias("section"), c.cast("string").alias("item")) for k, c in items.items()]
    )
    return (
        cells.select(F.inline(sections), "n", "s", "k")
        .groupBy("section", "item")
        .agg(F.sum("n").alias("records"), F.try_divide(F.sum("s"), F.sum("k")).alias("avg_price"))
    )


def require_loaded(report: DataFrame) -> DataFrame:
    """Raise when a :func:`validate_load` report covers no rows."""
    if report.filter("section = 'total' and records > 0").isEmpty():
        raise ValueError("the load is empty")
    return report
