"""Writes, row changes and partition changes on partitioned Parquet folders.

Changes are copy-on-write: the partitions that hold a changed row are found
first (reading only the columns of the condition), only those are read in full,
and one dynamic partition overwrite replaces them. The commit moves the new
files in after every task has finished, so a lost executor never leaves a
half-changed partition. There is no isolation for readers during the move and
no support for two writers at once.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Folder:
    """A partitioned Parquet folder with a declared schema (partition columns included)."""

    spark: SparkSession
    path: str
    schema: T.StructType
    by: tuple[str, ...]

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.fieldNames())


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


#: Folder name of a missing partition value, as Spark writes it.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def segment(values: dict[str, Any]) -> str:
    """Folder name of a partition, escaped as Spark writes it."""
    special = set('"#%\'*/:=?\\{[]^\x7f') | {chr(i) for i in range(1, 32)}

    def text(v: Any) -> str:
        if v is None or v == "":
            return NO_VALUE
        s = str(v).lower() if isinstance(v, bool) else str(v)
        return "".join(f"%{ord(ch):02X}" if ch in special else ch for ch in s)

    return "/".join(f"{k}={text(v)}" for k, v in values.items())


# ---- writes -----------------------------------------------------------------


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "append") -> None:
    """Write by partition value. Rows are rebalanced first: a value with most of
    the rows is written by many tasks, small values share one."""
    writer = df.hint("rebalance", *[F.col(c) for c in by]).write.partitionBy(*by)
    if mode == "replace_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)


def write_clustered(df: DataFrame, path: str, keys: list[str], files: int, mode: str = "errorifexists") -> None:
    """Write sorted by ``keys`` so that readers skip row groups by min and max.

    The row hash is a last sort column for the split only: rows of one hot key
    value go to as many files as they need.
    """
    tail = F.xxhash64(*[F.col(c) for c in df.columns])
    df.repartitionByRange(files, *keys, tail).sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def require_few_partitions(df: DataFrame, by: list[str], limit: int = 1000) -> int:
    """Raise when partitioning by ``by`` would make more than ``limit`` folders."""
    n = df.agg(F.approx_count_distinct(F.struct(*by), 0.02).alias("n")).first()["n"]
    if n > limit:
        raise ValueError(f"about {n} partitions by {by}, over the limit of {limit}; use a coarser key")
    return n


def write_chunks(df: DataFrame, path: str, key: str, chunks: int, only: list[int] | None = None) -> None:
    """Load in ``chunks`` parts by key hash, all in one pass over the source.

    ``only`` repeats some parts, say those that failed; each replaces itself.
    Unlike LIMIT/OFFSET the parts never overlap and need no order.
    """
    from brookmill.functions.hashing import shard_of

    parts = df.withColumn("chunk", shard_of(chunks, key))
    if only is not None:
        parts = parts.filter(F.col("chunk").isin(only))
    write_partitioned(parts, path, ["chunk"], "replace_partitions")


def create_as(df: DataFrame, path: str, by: list[str] | None = None) -> DataFrame:
    """Store a query result as a table and return the stored table."""
    if by:
        write_partitioned(df, path, by, "errorifexists")
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def append(folder: Folder, df: DataFrame) -> None:
    """Add rows; columns are matched by name and must have the declared types."""
    missing = set(folder.schema.fieldNames()) - set(df.columns)
    if missing:
        raise ValueError(f"columns {sorted(missing)} are missing")
    write_partitioned(_checked(folder, df), folder.path, list(folder.by))


def _checked(folder: Folder, df: DataFrame) -> DataFrame:
    """Columns in declared order and type. An empty text as partition value fails: its folder could not be told from NULL's."""

    def column(f: T.StructField) -> Column:
        c = F.col(f.name).cast(f.dataType)
        if f.name in folder.by and isinstance(f.dataType, T.StringType):
            c = F.when(c == "", F.raise_error(F.lit(f"empty text in partition column {f.name}")).cast("string")).otherwise(c)
        return c.alias(f.name)

    return df.select(*[column(f) for f in folder.schema])


# ---- row changes ------------------------------------------------------------


#: Up to so many partitions are named in a filter; beyond, the rows are found by a join. The result is the same.
NAMED = 1_000


def _touched(folder: Folder, condition: Column) -> list[dict[str, Any]]:
    """Partitions with a matching row. The condition reaches the scan; a condition
    that names partition columns lists only those folders.

    One name per partition comes to the driver, never data.
    """
    found = folder.read().filter(condition).select(*folder.by).distinct()
    return [r.asDict() for r in found.toLocalIterator()]


def rows_of(folder: Folder, parts: list[dict[str, Any]]) -> DataFrame:
    """All rows of the partitions."""
    rows = folder.read()
    if len(parts) <= NAMED:
        return rows.filter(in_partitions(folder, parts))
    kinds = T.StructType([f for f in folder.schema if f.name in folder.by])
    names = folder.spark.createDataFrame([tuple(p[f.name] for f in kinds) for p in parts], kinds)
    same = F.lit(True)
    for c in folder.by:
        same = same & rows[c].eqNullSafe(names[c])
    return rows.join(names, same, "left_semi")


def _emptied(folder: Folder, condition: Column, parts: list[dict[str, Any]]) -> list[dict[str, Any]]:
    """Those of ``parts`` in which every row matches."""
    rest = F.count_if(~F.coalesce(condition, F.lit(False)))
    rows = rows_of(folder, parts).groupBy(*folder.by).agg(rest.alias("__rest"))
    return [{c: r[c] for c in folder.by} for r in rows.filter("__rest = 0").toLocalIterator()]


def in_partitions(folder: Folder, parts: list[dict[str, Any]]) -> Column:
    """Predicate on partition columns, so only these folders are listed and read."""
    if len(folder.by) == 1:
        c = folder.by[0]
        values = [p[c] for p in parts if p[c] is not None]
        test = F.col(c).isin(values) if values else F.lit(False)
        return test | F.col(c).isNull() if len(values) < len(parts) else test
    test = F.lit(False)
    for p in parts:
        one = F.lit(True)
        for c in folder.by:
            one = one & F.col(c).eqNullSafe(F.lit(p[c]))
        test = test | one
    return test


def update_where(folder: Folder, condition: Column, changes: dict[str, Column]) -> int:
    """Set columns on matching rows; returns how many partitions were rewritten."""
    if set(changes) & set(folder.by):
        raise ValueError("a partition column cannot be updated in place")
    parts = _touched(folder, condition)
    if not parts:
        return 0
    hit = F.coalesce(condition, F.lit(False))
    kinds = {f.name: f.dataType for f in folder.schema}
    rows = rows_of(folder, parts)
    changed = rows.select(
        *[
            F.when(hit, changes[c].cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in rows.columns
        ]
    )
    write_partitioned(changed, folder.path, list(folder.by), "replace_partitions")
    return len(parts)


def delete_where(folder: Folder, condition: Column) -> int:
    """Remove matching rows; rows where the condition is NULL stay.

    A partition that loses all rows is dropped: an overwrite would leave it
    as it was.
    """
    parts = _touched(folder, condition)
    if not parts:
        return 0
    empty = _emptied(folder, condition, parts)
    gone = {tuple(p.values()) for p in empty}
    partly = [p for p in parts if tuple(p[c] for c in folder.by) not in gone]
    if partly:
        kept = rows_of(folder, partly).filter(~F.coalesce(condition, F.lit(False)))
        write_partitioned(kept, folder.path, list(folder.by), "replace_partitions")
    for p in empty:
        drop_partition(folder, p)
    return len(parts)


# ---- partition changes ------------------------------------------------------


def drop_partition(folder: Folder, values: dict[str, Any]) -> bool:
    """Remove one partition folder without reading it."""
    if tuple(values) != folder.by[: len(values)]:
        raise ValueError(f"partition columns are {folder.by}")
    fs, p = _fs(folder.spark, f"{folder.path}/{segment(values)}")
    return bool(fs.delete(p, True))


def replace_partition(folder: Folder, values: dict[str, Any], source: DataFrame) -> None:
    """Put the rows ``source`` has for one partition in place of the present ones."""
    rows = source
    for c, v in values.items():
        rows = rows.filter(F.col(c).eqNullSafe(F.lit(v)))
    if rows.isEmpty():
        drop_partition(folder, values)
        return
    write_partitioned(_checked(folder, rows), folder.path, list(folder.by), "replace_partitions")


def attach_all(folder: Folder, source: Folder) -> None:
    """Add every partition of another folder of the same shape. Its files hold one partition each, so no row is moved
    between tasks."""
    missing = set(folder.schema.fieldNames()) - set(source.schema.fieldNames())
    if missing or folder.by != source.by:
        raise ValueError(f"columns {sorted(missing)} are missing, or {source.by} is not {folder.by}")
    _checked(folder, source.read()).write.mode("append").partitionBy(*folder.by).parquet(folder.path)


def partition_names(folder: Folder) -> list[dict[str, str | None]]:
    """Partition values as text, from the folder names alone."""
    found: list[dict[str, str | None]] = [{}]
    for column in folder.by:
        deeper = []
        for values in found:
            fs, p = _fs(folder.spark, "/".join([folder.path, *([segment(values)] if values else [])]))
            for status in fs.listStatus(p) if fs.exists(p) else []:
                name, _, text = status.getPath().getName().partition("=")
                if status.isDirectory() and name == column:
                    deeper.append({**values, column: None if text == NO_VALUE else unquote(text)})
        found = deeper
    return found


def list_partitions(folder: Folder) -> DataFrame:
    """Partition values present, from the folder names; no file is read."""
    kinds = {f.name: f.dataType for f in folder.schema}
    rows = [tuple(p[c] for c in folder.by) for p in partition_names(folder)]
    texts = folder.spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in folder.by]))
    return texts.select(*[F.col(c).cast(kinds[c]).alias(c) for c in folder.by])


def expire(folder: Folder, ts: str, days: int, as_of: dt.datetime, day_number: str | None = None) -> int:
    """Remove rows older than ``as_of - days``. A row exactly on the cutoff stays.

    ``day_number`` names the partition column that holds the day of ``ts`` as
    yyyymmdd: then folders of earlier days are dropped by name, unread, and only
    the folder of the cutoff's day is read and rewritten. Without it all rows
    are looked at. Returns how many partitions changed.
    """
    cutoff = as_of - dt.timedelta(days=days)
    old = F.col(ts) < F.lit(cutoff)
    if day_number is None:
        return delete_where(folder, old)
    last = cutoff.year * 10_000 + cutoff.month * 100 + cutoff.day
    dropped = 0
    for values in partition_names(folder):
        if values[day_number] is not None and int(values[day_number]) < last:
            dropped += drop_partition(folder, values)
    return dropped + delete_where(folder, (F.col(day_number) == last) & old)


def move_into(spark: SparkSession, source: str, target: str) -> int:
    """Move the data files of a folder into another one of the same store, times unchanged; returns how many."""
    fs, p = _fs(spark, source)
    make = spark._jvm.org.apache.hadoop.fs.Path
    files = [f.getPath() for f in fs.listStatus(p) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    for f in files:
        if not fs.rename(f, make(f"{target}/{f.getName()}")):
            raise OSError(f"{f} cannot be moved")
    return len(files)


# ---- schema changes ---------------------------------------------------------


def add_columns(df: DataFrame, columns: dict[str, tuple[str, Any]]) -> DataFrame:
    """Read old rows with new columns: name -> (type, default). Nothing is rewritten.

    Works on a frame read with or without the new columns; NULL becomes the default.
    """
    new = {}
    for name, (kind, default) in columns.items():
        present = F.col(name) if name in df.columns else F.lit(None).cast(kind)
        new[name] = F.coalesce(present, F.lit(default).cast(kind)).cast(kind)
    return df.withColumns(new)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def evolved(folder: Folder, columns: dict[str, tuple[str, Any]], dropped: tuple[str, ...] = ()) -> DataFrame:
    """The folder under a changed schema: new columns with defaults, others gone.

    Files written before and after the change are read alike.
    """
    fields = [f for f in folder.schema if f.name not in dropped and f.name not in columns]
    for name, (kind, _) in columns.items():
        fields.append(T.StructField(name, T.DataType.fromDDL(kind), True))
    wide = Folder(folder.spark, folder.path, T.StructType(fields), folder.by)
    return add_columns(wide.read(), columns)
