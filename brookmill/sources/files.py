"""Text file readers and writers."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.functions.types import with_defaults
from brookmill.operators.tables import exists, segment
from brookmill.scratch import cut


def table_name(file_name: str) -> str:
    """Table name of a file: 'MenuItem.csv' -> 'menu_item'."""
    stem = re.sub(r"\.(csv|tsv|json|jsonl)(\.\w+)?$", "", file_name.rsplit("/", 1)[-1])
    return re.sub(r"(?<=[a-z])(?=[A-Z])", "_", stem).lower()


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, **options: Any) -> DataFrame:
    """CSV with a header under a declared schema. Compression follows the file name; globs work."""
    return spark.read.schema(schema).options(header=True, **options).csv(path)


def read_csv_tables(spark: SparkSession, folder: str, schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """One table per CSV file name below a folder, as declared in ``schemas``.

    Files of one name in several subfolders are one table. A declared table
    without a file is an error, so that an import never leaves one out unseen.
    Only names of declared tables reach the driver.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").option("recursiveFileLookup", "true")
    listed = reader.load(folder).select("path")
    found: dict[str, list[str]] = {}
    for row in listed.toLocalIterator():
        if (name := table_name(row["path"])) in schemas:
            found.setdefault(name, []).append(row["path"])
    if missing := sorted(set(schemas) - set(found)):
        raise FileNotFoundError(f"no CSV file for {', '.join(missing)} below {folder}")
    return {name: read_csv(spark, sorted(found[name]), schema) for name, schema in schemas.items()}


def read_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    return read_csv(spark, path, schema, sep="\t")


def numbered(pattern: str) -> str:
    """Expand '{0..2}' to the glob '{0,1,2}'."""

    def grow(m: re.Match) -> str:
        return "{" + ",".join(str(i) for i in range(int(m[1]), int(m[2]) + 1)) + "}"

    return re.sub(r"\{(\d+)\.\.(\d+)\}", grow, pattern)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, defaults: dict[str, Any] | None = None
) -> DataFrame:
    """JSON Lines under a declared schema, nested arrays included; NULL becomes the default."""
    return with_defaults(spark.read.schema(schema).json(path), defaults or {})


def read_daily_cases(
    df: DataFrame,
    numbers: list[str],
    day: str = "date",
    place: str = "location_key",
    after: dt.date | None = None,
    places: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows with a day and a place, optionally after a day and in some places,
    first rows first; missing numbers become 0 and the day becomes text."""
    df = df.filter(F.col(day).isNotNull() & F.col(place).isNotNull())
    if after is not None:
        df = df.filter(F.col(day) > F.lit(after))
    if places:
        df = df.filter(F.col(place).isin(places))
    df = df.orderBy(day, place)
    if limit:
        df = df.limit(limit)
    filled = {n: F.coalesce(F.col(n).try_cast("long"), F.lit(0)) for n in numbers if n in df.columns}
    return df.withColumns({**filled, day: F.date_format(day, "yyyy-MM-dd")})


def read_sensor_files(
    spark: SparkSession,
    headers: dict[tuple[str, ...], list[str]],
    schema: T.StructType,
    required: list[str],
    sep: str = ";",
) -> DataFrame:
    """Files of differing headers as one table.

    ``headers`` groups file paths by their header. A column a file lacks is
    filled with 0 for numbers and NULL for text; a field that does not parse is
    NULL; rows without ``required`` columns go.
    """
    kinds = {f.name: f for f in schema}
    out = None
    for header, paths in headers.items():
        part = spark.read.schema(T.StructType([kinds[h] for h in header])).options(
            header=True, sep=sep, mode="PERMISSIVE"
        ).csv(paths)
        for f in schema:
            if f.name not in header:
                absent = F.lit(0) if isinstance(f.dataType, T.NumericType) else F.lit(None)
                part = part.withColumn(f.name, absent.cast(f.dataType))
        part = part.select(*schema.fieldNames())
        out = part if out is None else out.unionByName(part)
    return out.filter(" AND ".join(f"{c} IS NOT NULL" for c in required))


def group_by_header(
    spark: SparkSession, paths: str | list[str], names: list[str], sep: str = ";"
) -> dict[tuple[str, ...], list[str]]:
    """Group files by header: the line made up of known column names only.

    All files are searched by one distributed job; one line per file comes back.
    """
    known = F.array(*[F.lit(n) for n in names])
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    # The cheap test on the first name comes first: data rows rarely pass it.
    first = F.split_part("value", F.lit(sep), F.lit(1)).isin(names)
    whole = F.size(F.array_except(F.split("value", re.escape(sep)), known)) == 0
    found = lines.filter(first & whole).select("value", F.col("_metadata.file_path").alias("path")).distinct()
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in found.toLocalIterator():
        groups.setdefault(tuple(row["value"].split(sep)), []).append(row["path"])
    return groups


def new_files(
    spark: SparkSession,
    folder: str,
    suffix: str,
    names: list[str] | None = None,
    after: tuple[dt.datetime, str] | None = None,
    limit: int | None = 10,
) -> DataFrame:
    """Files after the mark (time, path), oldest first, at most ``limit`` (None: all).

    Only the listing is read. ``names`` keeps files ending in ``_<name><suffix>``
    in any case. The caller moves its mark to the last row returned
    (:func:`last_file`) and calls again until nothing comes. Files of one time
    are told apart by their path, so the limit sets the size of a run and loses
    nothing.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
    files = reader.option("recursiveFileLookup", "true").load(folder).select("path", "modificationTime", "length")
    if after is not None:
        time, path = F.lit(after[0]), F.lit(after[1])
        changed = F.col("modificationTime")
        files = files.filter((changed > time) | ((changed == time) & (F.col("path") > path)))
    if names:
        test = F.lit(False)
        for n in names:
            test = test | F.endswith(F.lower("path"), F.lit(f"_{n.lower()}{suffix}"))
        files = files.filter(test)
    files = files.orderBy("modificationTime", "path")
    return files if limit is None else files.limit(limit)


def last_file(files: DataFrame) -> tuple[dt.datetime, str] | None:
    """The mark to go on from after these files; None if there are none."""
    row = files.agg(F.max(F.struct("modificationTime", "path")).alias("m")).first()["m"]
    return (row["modificationTime"], row["path"]) if row else None


class FileLedger:
    """The files a load has taken, one folder of paths per run.

    What is new is the listing without the ledger, so a file that arrives with
    an older time than others taken before is still found, and none is taken
    twice. A run that is repeated under its name replaces its own entry.
    """

    _SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("run", T.StringType())])

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def taken(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self._SCHEMA)
        return self.spark.read.schema(self._SCHEMA).parquet(self.path).select(*self._SCHEMA.fieldNames())

    def new(self, folder: str, suffix: str, names: list[str] | None = None, limit: int | None = 10) -> DataFrame:
        """Files below ``folder`` that no run has taken, oldest first, at most ``limit`` (None: all); see :func:`new_files`."""
        listed = new_files(self.spark, folder, suffix, names, limit=None)
        left = listed.join(self.taken().select("path"), "path", "left_anti").orderBy("modificationTime", "path")
        left = left.select("path", "modificationTime", "length")
        return left if limit is None else left.limit(limit)

    def take(self, run: str, folder: str, suffix: str, load: Callable[[list[str]], None], names: list[str] | None = None, limit: int | None = 10) -> int:
        """Choose new files, note them as this run's, and hand their paths to ``load``; returns how many.

        A run that was noted before gets the files noted then, so one that
        failed in ``load`` is repeated with the same files. ``load`` must
        replace what it wrote under the same run. ``limit`` paths come to the
        driver.
        """
        target = f"{self.path}/{segment({'run': run})}"
        if not exists(self.spark, f"{target}/_SUCCESS"):
            found = cut(self.new(folder, suffix, names, limit), "new-files")
            if found.isEmpty():
                return 0
            found.coalesce(1).write.mode("overwrite").parquet(target)
        paths = sorted(r["path"] for r in self.taken().filter(F.col("run") == run).select("path").toLocalIterator())
        load(paths)
        return len(paths)


def write_csv(df: DataFrame, path: str, **options: Any) -> None:
    df.write.options(header=True, **options).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)
