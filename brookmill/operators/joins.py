"""Joins and what the reference queries build from them.

No join of whole tables carries a broadcast hint. Spark broadcasts a side when
its measured size is below ``spark.sql.autoBroadcastJoinThreshold`` (adaptive
execution measures it at run time) and sort-merges beyond that.

:func:`lookup` and :func:`star` can take the frequent keys apart, whatever the
session does about skew: a mergeable frequency sketch finds them, at most
``1 / hot`` of them, their dictionary rows (one for each) go to every task, and
the rows of all other keys are joined plainly.
"""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_distinct(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, value: str, default: Any = ""
) -> DataFrame:
    """One row per left row and distinct ``value`` of its matches.

    A left row without a match keeps one row with ``default``. Repeats are
    removed before the join, so a key with very many matches shuffles only its
    distinct values.
    """
    values = right.select(F.col(right_key).alias("__k"), F.coalesce(value, F.lit(default)).alias(value)).distinct()
    joined = left.join(values, F.col(left_key) == F.col("__k"), "left")
    return joined.withColumn(value, F.coalesce(value, F.lit(default))).drop("__k")


def left_where_empty(left: DataFrame, right: DataFrame, left_key: str, right_key: str, value: str) -> DataFrame:
    """Rows of a left outer join whose text ``value`` is missing or ''.

    That is every left row without a match, and one row per match with '' or
    NULL. The two parts are made apart: the test on ``value`` then reaches the
    scan, and the join is an inner one, where a hot key can be split.
    """
    empty = right.filter(F.coalesce(value, F.lit("")) == "").select(
        F.col(right_key).alias("__k"), F.lit("").alias(value)
    )
    matched = left.join(empty, F.col(left_key) == F.col("__k")).drop("__k")
    return matched.unionByName(without_match(left, right, left_key, right_key).withColumn(value, F.lit("")))


def without_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left rows without a match; a NULL key never matches.

    Repeated right keys are dropped map-side; the join uses the same partitioning.
    """
    keys = right.select(F.col(right_key).alias("__k")).distinct()
    return left.join(keys, F.col(left_key) == F.col("__k"), "left_anti")


def with_rows(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left rows that have a match; only the distinct right keys are moved."""
    keys = right.select(F.col(right_key).alias("__k")).distinct()
    return left.join(keys, F.col(left_key) == F.col("__k"), "left_semi")


def frequent_keys(df: DataFrame, key: Column, share: float) -> list[Any]:
    """Values of ``key`` that may hold ``share`` of the rows or more: at most ``1 / share``, and every one that holds twice as much.

    One pass with a sketch of fixed size per task; ``df`` is not shuffled.
    """
    if not 0.001 <= share < 1:
        raise ValueError("share is between 0.001 and 1")
    most = math.floor(1 / share)
    tracked = 2 ** math.ceil(math.log2(max(64, 16 * most)))
    rows = df.select(key.alias("__k")).filter("__k IS NOT NULL")
    found = rows.agg(F.expr(f"approx_top_k(__k, {most}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] >= share * found["n"]]


def _join_apart(df: DataFrame, small: DataFrame, key: Column, how: str, hot: float | None) -> DataFrame:
    """Join on ``key`` = ``__k``, unique in ``small``; with ``hot`` the keys of that share of rows are taken apart."""
    keys = frequent_keys(df, key, hot) if hot else []
    if not keys:
        return df.join(small, key == F.col("__k"), how)
    frequent = F.coalesce(key.isin(keys), F.lit(False))
    few = F.broadcast(small.filter(F.col("__k").isin(keys)).dropDuplicates(["__k"]))
    rest = df.filter(~frequent).join(small.filter(~F.col("__k").isin(keys)), key == F.col("__k"), how)
    return df.filter(frequent).join(few, key == F.col("__k"), how).unionByName(rest)


def lookup(
    df: DataFrame, dictionary: DataFrame, key: str | Column, dict_key: str, attributes: dict[str, Any], hot: float | None = None
) -> DataFrame:
    """Add dictionary attributes; a missing key gives each attribute's default.

    ``attributes`` maps attribute name to default. The dictionary key must be
    unique (:func:`brookmill.operators.checks.duplicate_keys`). With ``hot``,
    keys with that share of the rows are joined apart; ``df`` is then read once
    more, and for each of the two joins.
    """
    key = F.col(key) if isinstance(key, str) else key
    small = dictionary.select(F.col(dict_key).alias("__k"), *[F.col(a).alias(f"__{a}") for a in attributes])
    joined = _join_apart(df, small, key, "left", hot)
    filled = {a: F.coalesce(F.col(f"__{a}"), F.lit(d)) for a, d in attributes.items()}
    return joined.withColumns(filled).select(*[c for c in df.columns if c not in attributes], *attributes)


def star(fact: DataFrame, *dimensions: tuple[DataFrame, str, str], hot: float | None = None) -> DataFrame:
    """Inner-join a fact table with dimensions given as (table, fact key, dimension key).

    Keys may also come from a dimension joined earlier in the list. With ``hot``
    keys with that share of the rows are joined apart, as in :func:`lookup`;
    dimension keys must then be unique.
    """
    for dim, fact_key, dim_key in dimensions:
        if hot:
            fact = _join_apart(fact, dim.withColumn("__k", F.col(dim_key)), F.col(fact_key), "inner", hot).drop("__k")
        else:
            fact = fact.join(dim, F.col(fact_key) == F.col(dim_key))
    return fact


def product_top(
    left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str], k: int
) -> DataFrame:
    """First ``k`` rows of all pairs, sorted by the left, then the right columns.

    The product is never built. A pair beyond the k smallest left rows has k
    pairs before it (each of those left rows with the smallest right row), and
    the same holds on the right, so the k smallest of each side are enough. Both
    hold at most k rows, whatever the inputs.
    """
    first_left = left.orderBy(*left_order).limit(k)
    first_right = right.orderBy(*right_order).limit(k)
    partners = first_right.agg(F.collect_list(F.struct(*right.columns)).alias("p")).scalar()
    pairs = first_left.withColumn("__p", F.explode(partners))
    return (
        pairs.select(*left.columns, *[F.col(f"__p.{c}").alias(c) for c in right.columns])
        .orderBy(*left_order, *right_order)
        .limit(k)
    )


def sample_rows(df: DataFrame, n: int, salt: int = 0, by: list[str] | None = None) -> DataFrame:
    """``n`` rows in an arbitrary but repeatable order."""
    from brookmill.functions.hashing import stable_number

    by = by or df.columns
    return df.orderBy(stable_number(F.lit(salt), *by), *by).limit(n)
