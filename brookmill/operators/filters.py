"""Row filters with optional bounds and lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def where_in(df: DataFrame, column: str, values: Iterable[Any] | None) -> DataFrame:
    """Keep rows whose ``column`` is in ``values``; an empty list keeps all."""
    values = list(values or ())
    return df.filter(F.col(column).isin(values)) if values else df


def between_days(
    df: DataFrame, column: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Keep whole days ``first`` to ``last``, both included, either one optional."""
    if first is not None:
        df = df.filter(F.col(column) >= F.lit(first))
    if last is not None:
        df = df.filter(F.col(column) < F.lit(last + dt.timedelta(days=1)))
    return df


def limit_then_filter(df: DataFrame, order: list[Column | str], n: int, condition: Column) -> DataFrame:
    """Take the first ``n`` rows in ``order``, then filter only those."""
    return df.orderBy(*order).limit(n).filter(condition)


def non_zero_point(lat: str = "lat", lon: str = "lon") -> Column:
    return (F.col(lat) != 0) & (F.col(lon) != 0)


def run_template(spark: SparkSession, text: str, tables: dict[str, DataFrame], **args: Any) -> DataFrame:
    """Run SQL with ``:name`` value parameters and ``{name}`` table parameters."""
    return spark.sql(text, args=args, **tables)
