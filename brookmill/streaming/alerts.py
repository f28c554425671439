"""Threshold alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def threshold_alerts(
    df: DataFrame,
    place: str,
    day: str,
    amount: str,
    threshold: int,
    as_of: dt.datetime,
    days: int = 1,
    kind: str = "HIGH_CASES",
    text: str = "High daily cases in ",
) -> DataFrame:
    """One alert per place whose sum since ``days`` before the day of ``as_of`` is over the threshold.

    The sum spans all those days and today, whatever the message calls it.
    """
    first = as_of.date() - dt.timedelta(days=days)
    sums = df.filter(F.col(day) >= F.lit(first)).groupBy(place).agg(F.sum(amount).alias("actual_value"))
    return sums.filter(F.col("actual_value") > threshold).select(
        F.lit(as_of).cast("timestamp_ntz").alias("alert_time"),
        F.col(place).alias("location_key"),
        F.lit(kind).alias("alert_type"),
        F.lit(threshold).alias("threshold_value"),
        "actual_value",
        F.concat(F.lit(text), F.col(place).cast("string"), F.lit(": "), F.col("actual_value").cast("string")).alias(
            "message"
        ),
    )
