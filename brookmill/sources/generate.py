"""Rows without an input table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmill.functions.hashing import stable_number


def numbers(spark: SparkSession, n: int, columns: dict[str, Column] | None = None) -> DataFrame:
    """Rows 0..n-1, made by the executors; ``columns`` are expressions over ``number``."""
    df = spark.range(n).withColumnRenamed("id", "number")
    return df.select(*[c.alias(k) for k, c in columns.items()]) if columns else df


def values(spark: SparkSession, rows: Sequence[tuple[Any, ...]], schema: str) -> DataFrame:
    """A few literal rows.

    Spark knows no size of rows made in Python and would sort both sides of a join; the hint spares the other side that.
    """
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def spread_days(df: DataFrame, first: str, days: int, *by: str) -> DataFrame:
    """Give every row a day out of ``days``, evenly and repeatably.

    A hash takes the place of a global row number, which would pull all rows
    through one task. The second column is a time inside that day.
    """
    day = F.date_add(F.to_date(F.lit(first)), (stable_number(*by) % days).cast("int"))
    moment = F.unix_timestamp(day.cast("timestamp")) + stable_number(F.lit(1), *by) % 86400
    return df.withColumns({"date": day, "partition_state": moment})
