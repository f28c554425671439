"""Emit the missing buckets of a time series."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of a block. A block that holds any is one group; the others follow from their neighbours.
_BLOCK = 4096


def missing_buckets(df: DataFrame, bucket: str, step: int, per: list[str]) -> DataFrame:
    """Return (*per, bucket): the buckets from the overall smallest to the largest, ``step`` apart, that a series lacks.

    A series is one combination of ``per``, NULL included. Buckets are counted
    from the smallest one and dealt to blocks of fixed length. Within a block
    the missing ones are all less the present ones; blocks without any lie
    between those of neighbouring present blocks. So no series is crossed with
    the buckets, the rows of a series are spread over its blocks, and the work
    is that of the rows that come in and go out.
    """
    ends = df.agg(F.min(bucket).alias("lo"), F.max(bucket).alias("hi")).first()
    if ends["lo"] is None:
        return df.select(*per, bucket).limit(0)
    points = (ends["hi"] - ends["lo"]) // step + 1
    blocks = -(-points // _BLOCK)
    after = F.col(bucket) - F.lit(ends["lo"])
    place = F.floor(after / step).cast("long")
    on_grid = F.when(after % step == 0, place % _BLOCK)
    rows = df.filter(F.col(bucket).isNotNull()).select(*per, F.floor(place / _BLOCK).alias("__block"), on_grid.alias("__place"))
    held = rows.groupBy(*per, "__block").agg(F.collect_set("__place").alias("__held"))
    if per:
        order = Window.partitionBy(*per).orderBy("__block")
        known = held.select(*per, "__block", F.lag("__block").over(order).alias("__before"), F.lead("__block").over(order).alias("__next"))
        behind = F.sequence(F.col("__block") + 1, F.coalesce("__next", F.lit(blocks)) - 1)
        ahead = F.sequence(F.lit(0).cast("long"), F.col("__block") - 1)
        none = F.array().cast("array<bigint>")
        between = F.when(F.coalesce("__next", F.lit(blocks)) > F.col("__block") + 1, behind).otherwise(none)
        first = F.when(F.col("__before").isNull() & (F.col("__block") > 0), ahead).otherwise(none)
        empty = known.select(*per, F.explode(F.concat(first, between)).alias("__block"))
    else:
        empty = df.sparkSession.range(blocks).toDF("__block").join(held.select("__block"), "__block", "left_anti")
    whole = held.unionByName(empty.withColumn("__held", F.array().cast("array<bigint>")))
    last = F.least(F.lit(_BLOCK).cast("long"), F.lit(points) - F.col("__block") * _BLOCK) - 1
    lacking = F.explode(F.array_except(F.sequence(F.lit(0).cast("long"), last), "__held")).alias("__place")
    return whole.select(*per, "__block", lacking).select(*per, (F.lit(ends["lo"]) + (F.col("__block") * _BLOCK + F.col("__place")) * step).alias(bucket))


def fill_gaps(
    df: DataFrame, bucket: str, step: int, defaults: dict[str, Any], per: list[str] | None = None
) -> DataFrame:
    """Add one row per missing bucket with ``defaults`` in the other columns.

    ``bucket`` is a whole number (epoch seconds); rows without one stay as they
    are. With ``per`` the gaps of each combination of those columns are filled
    between the overall ends. The ends are looked up when this is called.
    """
    df = df.withColumn(bucket, F.col(bucket).cast("long"))
    per = per or []
    types = dict(df.dtypes)
    missing = missing_buckets(df, bucket, step, per)
    filler = missing.select(
        *[F.col(c) if c in (*per, bucket) else F.lit(defaults.get(c)).cast(types[c]).alias(c) for c in df.columns]
    )
    return df.unionByName(filler)
