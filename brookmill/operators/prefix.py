"""Running sums and exact quantiles that survive hot keys.

A plain window sorts one key in one task. That is the best plan while every key
is small, and it is what is used then: the row count of the largest key is
measured first, reading only the key columns.

With a larger key the rows are range-partitioned by (keys, order, tie), in as
many parts as hold ``HOT_ROWS`` rows each, so that one key with a third of all
rows is worked on by many tasks. Totals per (key, part) come with map-side
combine, offsets per part from those few totals, and the window runs inside
each (key, part). Parts follow the order, so the result is that of the plain
window; no row is dropped.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmill.scratch import cut

HOT_ROWS = 1_000_000

_RANGE = "__range"


def _same(keys: list[str], prefix: str) -> Column:
    test = F.lit(True)
    for i, k in enumerate(keys):
        test = test & F.col(k).eqNullSafe(F.col(f"{prefix}{i}"))
    return test


def largest_key(df: DataFrame, keys: list[str]) -> int:
    """Row count of the largest key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0


def running_sum(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    out: str = "running",
    tie: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over the rows up to this one, per ``keys`` by ``order``.

    Rows with equal order values are ordered by ``tie`` (default: all columns),
    at any size; NULLs come first. ``largest`` is the row count of the largest
    key where the caller knows it. Splitting reads ``df`` three times; store it
    first (:func:`brookmill.scratch.cut`) when it is costly to compute.
    """
    tie = [c for c in (tie or df.columns) if c != order]
    if largest is None:
        largest = largest_key(df, keys)
    columns = [F.col(c) for c in df.columns]
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if largest <= hot_rows:
        running = F.sum(value).over(upto(Window.partitionBy(*keys).orderBy(order, *tie)))
        return df.select(*columns, F.coalesce(running, F.lit(0)).alias(out))

    parts = max(2, math.ceil(df.count() / hot_rows))
    ranged = df.repartitionByRange(parts, *keys, order, *tie).withColumn(_RANGE, F.spark_partition_id())
    spread = cut(ranged, "running-ranges")
    before = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spread.groupBy(*keys, _RANGE)
        .agg(F.sum(value).alias("__s"))
        .select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
            F.col(_RANGE).alias("__r"),
            F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__offset"),
        )
    )
    inside = upto(Window.partitionBy(*keys, _RANGE).orderBy(order, *tie))
    summed = spread.withColumn("__in", F.sum(value).over(inside))
    joined = summed.join(offsets, (F.col(_RANGE) == F.col("__r")) & _same(keys, "__k"))
    return joined.select(*columns, (F.coalesce("__in", F.lit(0)) + F.col("__offset")).alias(out))


def _reached(at: Column, size: Column, q: float, kind: str, upper: bool = False) -> Column:
    """Whether the rows up to position ``at`` hold the wanted one of ``size`` rows."""
    if kind == "element":
        # The small slack takes back what q * n gains by rounding (0.07 * 100 > 7).
        return at >= size * F.lit(float(q)) - 1e-6
    spot = (size - 1) * F.lit(float(q))
    return at > (F.ceil(spot) if upper else F.floor(spot))


def _pick(value: Column, at: Column, size: Column, q: float, kind: str) -> Column:
    """Aggregate: the quantile, from distinct values and the positions they reach up to."""
    low = F.min(F.when(_reached(at, size, q, kind), value))
    if kind == "element":
        return low
    high = F.min(F.when(_reached(at, size, q, kind, upper=True), value))
    spot = F.max((size - 1) * F.lit(float(q)))
    return low + (high - low) * (spot - F.floor(spot))


def _quantiles_by_count(present, keys, value, quantiles, kind, hot_rows, largest) -> DataFrame:
    """All distinct values with their counts, in order."""
    counted = present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    v, at, size = F.col(value), F.col("__upto"), F.col("__all")
    picks = [_pick(v, at, size, q, kind).alias(n) for n, q in quantiles.items()]
    if largest <= hot_rows:
        # Positions and sizes come from one shuffle of the counts by key.
        whole = Window.partitionBy(*keys)
        upto = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return counted.select("*", F.sum("__n").over(upto).alias("__upto"), F.sum("__n").over(whole).alias("__all")).groupBy(*keys).agg(*picks)
    counted = cut(counted, "value-counts")
    placed = running_sum(counted, keys, value, "__n", "__upto", tie=[value], hot_rows=hot_rows)
    sizes = counted.groupBy(*keys).agg(F.sum("__n").alias("__all"))
    sizes = sizes.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__all")
    return placed.join(sizes, _same(keys, "__k")).groupBy(*keys).agg(*picks)


def _quantiles_by_bracket(present, keys, value, quantiles, kind, hot_rows, accuracy) -> DataFrame | None:
    """Count below a bracket around each quantile and order only the values inside it.

    The bracket comes from a sketch whose rank error is under 1 / ``accuracy``
    and is three times as wide; keys with at most ``accuracy`` rows are taken
    whole. Every count is exact, so a bracket that missed would show: then the
    result is None.
    """
    margin, items = 3 / accuracy, list(quantiles.items())
    cuts = [c for _, q in items for c in (max(q - margin, 0.0), min(q + margin, 1.0))]
    sketch = F.percentile_approx(value, F.array(*[F.lit(c) for c in cuts]), F.lit(accuracy))
    sized = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("__all"), sketch.alias("__c"))
    sized = cut(
        sized.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__all", "__c"), "quantile-brackets"
    )
    joined = present.select(*keys, value).join(sized, _same(keys, "__k"))
    v, at, size, big = F.col(value), F.col("__at"), F.col("__all"), F.col("__all") > accuracy
    below, inside = [], []
    for i, (_, q) in enumerate(items):
        under = F.coalesce(v < F.when(big, F.col("__c")[2 * i]), F.lit(False)) if q > margin else F.lit(False)
        over = F.coalesce(v > F.when(big, F.col("__c")[2 * i + 1]), F.lit(False)) if q < 1 - margin else F.lit(False)
        below.append(F.count_if(under).alias(f"__b{i}"))
        inside.append(F.when(~under & ~over, F.lit(i)))
    lower = joined.groupBy(*keys).agg(F.max("__all").alias("__all"), *below)
    lower = lower.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        "__all",
        F.inline(F.array(*[F.struct(F.lit(i).alias("__j"), F.col(f"__b{i}").alias("__below")) for i in range(len(items))])),
    )
    values = joined.select(*keys, value, F.explode(F.array_compact(F.array(*inside))).alias("__i"))
    counted = cut(values.groupBy(*keys, "__i", value).agg(F.count(F.lit(1)).alias("__n")), "bracket-counts")
    placed = running_sum(counted, [*keys, "__i"], value, "__n", "__upto", tie=[value], hot_rows=hot_rows)
    placed = placed.join(lower, (F.col("__i") == F.col("__j")) & _same(keys, "__k"))
    placed = placed.withColumn("__at", F.col("__below") + F.col("__upto"))
    picks, sure = [], F.lit(True)
    for i, (name, q) in enumerate(items):
        mine = F.col("__i") == i
        picks.append(_pick(v, F.when(mine, at), F.when(mine, size), q, kind).alias(name))
        missed_below = F.max(F.when(mine, _reached(F.col("__below"), size, q, kind) & (F.col("__below") > 0)))
        enough = F.max(F.when(mine, _reached(at, size, q, kind, upper=True)))
        sure = sure & F.coalesce(~missed_below & enough, F.lit(False))
    result = cut(placed.groupBy(*keys).agg(*picks, sure.alias("__sure")), "quantiles")
    return result.drop("__sure") if result.filter(~F.col("__sure")).isEmpty() else None


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    quantiles: dict[str, float],
    kind: str = "element",
    hot_rows: int = HOT_ROWS,
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact quantiles per key without holding a group in memory.

    ``kind="element"`` picks a value that occurs: the first one whose share of
    rows up to it reaches q. ``kind="between"`` interpolates linearly between
    neighbours. NULLs do not count; a key with only NULLs gives no row.

    While every key is small, equal values are counted before the shuffle and
    positions come from a running sum. With a key over ``hot_rows`` rows only
    the values near each quantile are shuffled: a sketch brackets them, the rows
    below are counted exactly.
    """
    columns = [*keys, *quantiles]
    present = df.filter(F.col(value).isNotNull()).select(*keys, value)
    if not keys:
        keys, present = ["__one"], present.withColumn("__one", F.lit(1))
    largest = largest_key(present, keys)
    result = None
    if largest > hot_rows:
        result = _quantiles_by_bracket(present, keys, value, quantiles, kind, hot_rows, accuracy)
    if result is None:
        result = _quantiles_by_count(present, keys, value, quantiles, kind, hot_rows, largest)
    return result.select(*columns)
