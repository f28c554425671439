"""Aggregates beyond one ``groupBy().agg()``."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.functions.types import round_to
from brookmill.operators.prefix import running_sum


PART_ROWS = 100_000


def collect_parts(
    df: DataFrame, keys: list[str], value: str, tie: list[str], part_rows: int = PART_ROWS, out: str = "values"
) -> DataFrame:
    """Arrays of the values of each key, sorted: ``part`` 0 holds the first ``part_rows`` of them, and so on.

    The rule is the same at any size, so a key's rows follow from its values
    alone, and no task or array holds more than ``part_rows`` of them. NULL
    values are left out; ``tie`` orders equal values. Reads ``df`` more than once.
    """
    present = df.filter(F.col(value).isNotNull()).withColumn("__one", F.lit(1))
    placed = running_sum(present, keys, value, "__one", "__place", tie=tie)
    part = F.floor((F.col("__place") - 1) / part_rows).cast("int").alias("part")
    return placed.groupBy(*keys, part).agg(F.sort_array(F.collect_list(value)).alias(out))


def part_sql(keys: str, order: str) -> str:
    """The SQL form of ``part``, as a window expression."""
    return f"CAST((row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - 1) // {PART_ROWS} AS INTEGER)"


def correlations(df: DataFrame, columns: dict[str, str], digits: int | None = None) -> DataFrame:
    """Correlation of every pair of columns, strongest first, in one pass.

    ``columns`` maps a label to a column.
    """
    pairs = list(combinations(columns.items(), 2))
    one_row = df.agg(*[F.corr(a[1], b[1]).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(F.lit(a[0]).alias("param_x"), F.lit(b[0]).alias("param_y"), F.col(f"c{i}").alias("correlation"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    long = one_row.select(F.inline(rows))
    if digits is not None:
        long = long.withColumn("correlation", round_to("correlation", digits))
    return long.orderBy(F.abs("correlation").desc(), "param_x", "param_y")


def coverage(c: str) -> Column:
    """Share of rows with a value."""
    return F.avg(F.when(F.col(c).isNotNull(), 1.0).otherwise(0.0))


def avg_if(value: str, condition: Column) -> Column:
    """Average over the rows that match; 0 when none does."""
    return F.coalesce(F.avg(F.when(condition, F.col(value))), F.lit(0.0))


def seconds_between(first: Column, last: Column) -> Column:
    return F.unix_timestamp(last.cast("timestamp")) - F.unix_timestamp(first.cast("timestamp"))


def unpivot_measures(df: DataFrame, keep: list[str], measures: dict[str, Column], name: str, value: str) -> DataFrame:
    """One row per input row and measure."""
    pairs = F.array(
        *[F.struct(F.lit(label).alias(name), c.cast("double").alias(value)) for label, c in measures.items()]
    )
    return df.select(*keep, F.inline(pairs))


def labelled_counts(parts: dict[str, DataFrame], label: str = "method", count: str = "records") -> DataFrame:
    """One row per named table with its row count."""
    out = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias(count)).select(F.lit(name).alias(label), count)
        out = one if out is None else out.unionByName(one)
    return out
