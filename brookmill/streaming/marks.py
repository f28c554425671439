"""High-water-mark loads.

The mark is the pair (time, id) of the last row taken, kept in a small table.
A mark of the day alone would lose the rest of a day when a load stops inside it.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.operators.tables import exists

#: Mark values a plan chooses the ends of its steps from; more steps than these are not planned at once.
PLAN_QUANTILES = 1000


def read_mark(spark: SparkSession, path: str) -> tuple[Any, Any] | None:
    """Last stored mark, or None before the first load."""
    if not exists(spark, path):
        return None
    r = spark.read.parquet(path).orderBy(F.col("step").desc()).first()
    return (r["mark"], r["mark_id"]) if r else None


def rows_after(src: DataFrame, mark: str, row_id: str, last: tuple[Any, Any] | None) -> DataFrame:
    """Rows strictly after a mark. A mark without an id (None) means the whole of that
    value was taken. The first test alone reaches the scan."""
    if last is None:
        return src
    value, at = last
    if at is None:
        return src.filter(F.col(mark) > F.lit(value))
    later = (F.col(mark) > F.lit(value)) | ((F.col(mark) == F.lit(value)) & (F.col(row_id) > F.lit(at)))
    return src.filter(F.col(mark) >= F.lit(value)).filter(later)


def rows_without_mark(src: DataFrame, mark: str) -> DataFrame:
    """Rows that no high-water mark can ever reach, for a side table."""
    return src.filter(F.col(mark).isNull())


def load_step(
    src: DataFrame,
    mark: str,
    row_id: str,
    out_path: str,
    mark_path: str,
    limit: int | None = None,
    manual: Any | None = None,
) -> int:
    """Take the next rows, store them, move the mark. Returns the number of rows.

    ``limit`` is the wished size of a step. A step ends at a mark value found by
    an approximate quantile and takes that value whole, so nothing is sorted or
    counted off in one task; a value with very many rows makes a larger step.
    Rows without a mark have no place in the order: no step takes them, at any
    limit; :func:`rows_without_mark` gives them.
    ``manual`` overrides the stored mark. Each step writes its own folder and the
    mark goes last, so a step that failed is repeated in full. With nothing new
    the mark stays. ``mark`` is a number, date or timestamp.
    """
    spark = src.sparkSession
    stored = read_mark(spark, mark_path)
    last = (manual, None) if manual is not None else stored
    rows = rows_after(src.filter(F.col(mark).isNotNull()), mark, row_id, last)
    if limit is not None:
        waiting = rows.count()
        if waiting > limit:
            end = rows.agg(F.percentile_approx(mark, limit / waiting, 10_000).alias("e")).first()["e"]
            rows = rows.filter(F.col(mark) <= F.lit(end).cast(src.schema[mark].dataType))
    step = 0
    if stored is not None:
        step = spark.read.parquet(mark_path).agg(F.max("step").alias("s")).first()["s"] + 1
    target = f"{out_path}/step={step}"
    rows.write.mode("overwrite").parquet(target)
    done = spark.read.schema(src.schema).parquet(target)
    end = done.agg(
        F.max(F.struct(F.col(mark).alias("mark"), F.col(row_id).alias("mark_id"))).alias("m"),
        F.count(F.lit(1)).alias("n"),
    ).select("m.mark", "m.mark_id", "n")
    n = end.first()["n"]
    if n:
        end.select("mark", "mark_id", F.lit(step).alias("step")).coalesce(1).write.mode("append").parquet(mark_path)
    return n


def plan_steps(src: DataFrame, mark: str, plan_path: str, limit: int, after: Any | None = None) -> int:
    """Find the ends of all steps of a load at once and store them; returns the number of steps.

    One pass counts the rows after the mark ``after`` and takes the quantiles of
    their mark values; every step takes about ``limit`` rows and whole mark
    values. The plan is rows (step, low, high) with low exclusive, null for the
    first step of a first load. A plan that is stored stays as it is.
    """
    spark = src.sparkSession
    if exists(spark, f"{plan_path}/_SUCCESS"):
        return spark.read.parquet(plan_path).count()
    rows = src.filter(F.col(mark).isNotNull()).select(F.col(mark).alias("m"))
    if after is not None:
        rows = rows.filter(F.col("m") > F.lit(after))
    parts = [i / PLAN_QUANTILES for i in range(1, PLAN_QUANTILES + 1)]
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max("m").alias("top"), F.percentile_approx("m", F.array(*[F.lit(p) for p in parts]), 10 * PLAN_QUANTILES).alias("ends")).first()
    if not seen["n"]:
        return 0
    every = max(1, round(PLAN_QUANTILES * limit / seen["n"]))
    ends = sorted(set(seen["ends"][every - 1 :: every]) | {seen["top"]})
    kind = src.schema[mark].dataType
    shape = T.StructType([T.StructField("step", T.IntegerType()), T.StructField("low", kind), T.StructField("high", kind)])
    plan = spark.createDataFrame([(i, low, high) for i, (low, high) in enumerate(zip([after, *ends[:-1]], ends, strict=True))], shape)
    plan.coalesce(1).write.mode("overwrite").parquet(plan_path)
    return len(ends)


def planned_rows(src: DataFrame, mark: str, plan_path: str, step: int) -> DataFrame:
    """Rows of one planned step; its range reaches the scan. The same at every call while ``src`` only grows behind the plan."""
    r = src.sparkSession.read.parquet(plan_path).filter(F.col("step") == step).first()
    rows = src.filter(F.col(mark) <= F.lit(r["high"]))
    return rows if r["low"] is None else rows.filter(F.col(mark) > F.lit(r["low"]))


def load_planned(src: DataFrame, mark: str, out_path: str, plan_path: str, step: int) -> None:
    """Store one planned step in a folder of its own. Steps may run in any order or side by side; a repeated one replaces itself."""
    planned_rows(src, mark, plan_path, step).write.mode("overwrite").parquet(f"{out_path}/step={step}")
