"""Resolve appended versions and deltas at read time.

Spark keeps no insertion order, so functions that depend on one take ``seq``, a
column that grows with every append (batch number and row number, say). All of
them are hash aggregations with a map-side step: a key with very many versions
is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _others(df: DataFrame, *taken: str) -> list[str]:
    return [c for c in df.columns if c not in taken]


def latest_by_key(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Last row per key. Use :func:`equal_seq` to find keys where ``seq`` does not decide.

    Rows with equal ``seq`` are told apart by their other columns, so the choice
    is at least the same in every run.
    """
    rest = _others(df, *keys, seq)
    newest = F.max(F.struct(F.col(seq), *[F.col(c) for c in rest])).alias("__m")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"__m.{c}").alias(c) for c in df.columns if c not in keys])


def equal_seq(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Keys and ``seq`` values that occur more than once."""
    return df.groupBy(*keys, seq).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def sum_by_key(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Sum numeric columns per key; refuses a column that cannot be summed."""
    for c in columns:
        if not isinstance(df.schema[c].dataType, T.NumericType):
            raise TypeError(f"column {c} is {df.schema[c].dataType.simpleString()}, only numbers can be summed")
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def collapse(df: DataFrame, keys: list[str], sign: str, seq: str) -> DataFrame:
    """Cancel +1 against -1 rows of a key.

    More +1: the last +1 row stays. More -1: the first -1 row stays. Equal: none.
    """
    rest = _others(df, *keys, sign, seq)
    row = F.struct(F.col(seq), *[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(
        F.sum(F.col(sign).cast("long")).alias("__s"),
        F.max(F.when(F.col(sign) > 0, row)).alias("__up"),
        F.min(F.when(F.col(sign) < 0, row)).alias("__down"),
    )
    return _signed_rows(agg, df, keys, sign)


def collapse_versioned(df: DataFrame, keys: list[str], version: str, sign: str) -> DataFrame:
    """Cancel +1 against -1 rows of the same key and version, in any arrival order."""
    rest = _others(df, *keys, version, sign)
    # An empty struct is not allowed, so the version rides along when keys and
    # version are all there is.
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.col(version).alias("__v"))
    agg = df.groupBy(*keys, version).agg(
        F.sum(F.col(sign).cast("long")).alias("__s"),
        F.max(F.when(F.col(sign) > 0, row)).alias("__up"),
        F.max(F.when(F.col(sign) < 0, row)).alias("__down"),
    )
    return _signed_rows(agg, df, [*keys, version], sign)


def _signed_rows(agg: DataFrame, df: DataFrame, keys: list[str], sign: str) -> DataFrame:
    kept = agg.filter("__s != 0").withColumn("__r", F.when(F.col("__s") > 0, F.col("__up")).otherwise(F.col("__down")))
    kind = df.schema[sign].dataType
    out = []
    for c in df.columns:
        if c in keys:
            out.append(F.col(c))
        elif c == sign:
            out.append(F.when(F.col("__s") > 0, 1).otherwise(-1).cast(kind).alias(c))
        else:
            out.append(F.col(f"__r.{c}").alias(c))
    return kept.select(*out)


def signed_totals(df: DataFrame, keys: list[str], columns: list[str], sign: str) -> DataFrame:
    """Sums weighted with the sign: the totals after cancelling, without cancelling."""
    return df.groupBy(*keys).agg(
        F.sum(F.col(sign).cast("long")).alias("rows"),
        *[F.sum(F.col(c) * F.col(sign)).alias(c) for c in columns],
    )
