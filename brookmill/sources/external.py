"""Tables of an external store as a data source: planned in ranges, filtered inside, appended to by commit.

A table is a folder with ``data/`` (Parquet files) and ``commits/`` (one list of
files per append). Only files of a commit are part of the table. A write task
puts its rows into a file of its own and reports it; the commit names the files
of the tasks that Spark counts as done, so what a failed, repeated or
speculative task left behind is never read. Rows can be added, not changed.

Filters reach the source where ``spark.sql.python.filterPushdown.enabled`` is set
when the table is opened (:mod:`brookmill.session` sets it); without it Spark
filters. Spark refuses a reader that takes filters in a session without the
setting, so the option ``pushFilters``, which :func:`read_external` fills in from
the session, picks the reader.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

FORMAT = "external_table"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Bytes of row groups that one read task takes, about.
TASK_BYTES = 64 << 20

_COMPARED = {ds.EqualTo: "equal", ds.GreaterThan: "greater", ds.GreaterThanOrEqual: "greater_equal", ds.LessThan: "less", ds.LessThanOrEqual: "less_equal"}

#: Values that compare alike in Spark and in the files.
_SIMPLE = (int, str, dt.date)


def _open(options: dict[str, str]) -> tuple[pafs.FileSystem, str]:
    """File system and folder of the table an option set names."""
    if not options.get("path") or not options.get("table"):
        raise ValueError("options path and table are required")
    found, root = pafs.FileSystem.from_uri(options["path"]) if "://" in options["path"] or options["path"].startswith("file:") else (pafs.LocalFileSystem(), options["path"])
    return found, f"{root.rstrip('/')}/{options['table']}"


def _files(store: pafs.FileSystem, folder: str) -> list[dict[str, Any]]:
    """Committed files with their rows, in the order of commits."""
    listed = store.get_file_info(pafs.FileSelector(f"{folder}/commits", allow_not_found=True))
    out = []
    for info in sorted((i for i in listed if i.base_name.endswith(".json")), key=lambda i: i.base_name):
        with store.open_input_stream(info.path) as f:
            out += json.loads(f.read())["files"]
    return out


@dataclass
class RowGroups(ds.InputPartition):
    """Row groups of one file that one task reads."""

    path: str
    groups: list[int]

    def __init__(self, path: str, groups: list[int]):
        super().__init__((path, groups))
        self.path, self.groups = path, groups


def _test(f: ds.Filter) -> tuple[str, Any, str] | None:
    """(column, value, comparison) of a filter the source can apply exactly as Spark would, else None."""
    if len(getattr(f, "attribute", ())) != 1:
        return None
    column = f.attribute[0]
    if isinstance(f, ds.IsNull | ds.IsNotNull):
        return column, None, "is_null" if isinstance(f, ds.IsNull) else "is_valid"
    if isinstance(f, ds.In) and all(type(v) in _SIMPLE for v in f.value):
        return column, tuple(f.value), "in"
    if type(f) in _COMPARED and type(f.value) in _SIMPLE:
        return column, f.value, _COMPARED[type(f)]
    return None


def _expression(tests: list[tuple[str, Any, str]]) -> pc.Expression | None:
    out = None
    for column, value, how in tests:
        c = pc.field(column)
        one = c.isin(list(value)) if how == "in" else getattr(c, how)() if value is None else getattr(pc, how)(c, pc.scalar(value))
        out = one if out is None else out & one
    return out


def _may_match(statistics: pq.Statistics | None, value: Any, how: str) -> bool:
    """Whether a row group with these statistics can hold a match."""
    if statistics is None:
        return True
    if how in ("is_null", "is_valid"):
        return not statistics.has_null_count or (statistics.null_count > 0 if how == "is_null" else statistics.num_values > 0)
    if not statistics.has_min_max:
        return True
    low, high = statistics.min, statistics.max
    tests = {"equal": lambda v: low <= v <= high, "greater": lambda v: high > v, "greater_equal": lambda v: high >= v, "less": lambda v: low < v, "less_equal": lambda v: low <= v}
    try:
        return any(tests["equal"](v) for v in value) if how == "in" else tests[how](value)
    except TypeError:
        return True


class Reader(ds.DataSourceReader):
    """Reads the whole table; the filters are left to Spark."""

    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.options, self.schema, self.tests = options, schema, []

    def partitions(self) -> list[RowGroups]:
        """Row groups that may hold a match, dealt in ranges of about ``taskBytes``."""
        store, folder = _open(self.options)
        size = int(self.options.get("taskbytes", TASK_BYTES))
        out = []
        for entry in _files(store, folder):
            path = f"{folder}/data/{entry['name']}"
            with store.open_input_file(path) as f:
                meta = pq.ParquetFile(f).metadata
            column = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
            groups, held = [], 0
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                if not all(_may_match(group.column(column[c]).statistics, v, how) for c, v, how in self.tests if c in column):
                    continue
                if groups and held + group.total_byte_size > size:
                    out.append(RowGroups(path, groups))
                    groups, held = [], 0
                groups.append(g)
                held += group.total_byte_size
            if groups:
                out.append(RowGroups(path, groups))
        return out or [RowGroups("", [])]

    def read(self, partition: RowGroups) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, _ = _open(self.options)
        shape = to_arrow_schema(self.schema)
        keep = _expression(self.tests)
        with store.open_input_file(partition.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(row_groups=partition.groups):
                rows = pa.Table.from_batches([batch])
                rows = rows.filter(keep) if keep is not None else rows
                columns = [rows[n] if n in rows.column_names else pa.nulls(rows.num_rows) for n in shape.names]
                yield from pa.Table.from_arrays([c.cast(k) for c, k in zip(columns, shape.types, strict=True)], schema=shape).to_batches()


class FilteringReader(Reader):
    """Reads the rows that pass the filters it takes."""

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        simple = {f.name for f in self.schema if isinstance(f.dataType, T.IntegralType | T.StringType | T.DateType)}
        for f in filters:
            test = _test(f)
            if test and (test[0] in simple or test[1] is None):
                self.tests.append(test)
            else:
                yield f


@dataclass
class Written(ds.WriterCommitMessage):
    """The file of one task; no name where it had no rows."""

    name: str | None
    rows: int = 0


class Writer(ds.DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.options, self.schema, self.job = options, schema, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = _open(self.options)
        store.create_dir(f"{folder}/data")
        name, rows, out = f"{self.job}-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                out = out or pq.ParquetWriter(f"{folder}/data/{name}", batch.schema, filesystem=store)
                out.write_batch(batch, row_group_size=int(self.options.get("grouprows", 1 << 17)))
                rows += batch.num_rows
        finally:
            if out:
                out.close()
        return Written(name if rows else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = _open(self.options)
        store.create_dir(f"{folder}/commits")
        files = [{"name": m.name, "rows": m.rows} for m in messages if m is not None and m.name]
        number = len(store.get_file_info(pafs.FileSelector(f"{folder}/commits")))
        body = json.dumps({"schema": self.schema.jsonValue(), "files": files}).encode()
        with store.open_output_stream(f"{folder}/commits/{self.job}.tmp") as f:
            f.write(body)
        store.move(f"{folder}/commits/{self.job}.tmp", f"{folder}/commits/{number:09d}-{self.job}.json")

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = _open(self.options)
        for m in messages:
            if m is not None and m.name:
                store.delete_file(f"{folder}/data/{m.name}")


class ExternalTable(ds.DataSource):
    """``spark.read.format(FORMAT).option("path", ...).option("table", ...)``; ``taskBytes`` sizes read tasks, ``groupRows`` written row groups,
    ``pushFilters`` (false) takes filters and needs :data:`PUSHDOWN`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        store, folder = _open(self.options)
        listed = store.get_file_info(pafs.FileSelector(f"{folder}/commits", allow_not_found=True))
        commits = sorted(i.path for i in listed if i.base_name.endswith(".json"))
        if not commits:
            raise FileNotFoundError(f"there is no table {self.options['table']} in {self.options['path']}")
        with store.open_input_stream(commits[-1]) as f:
            return T.StructType.fromJson(json.loads(f.read())["schema"])

    def reader(self, schema: T.StructType) -> Reader:
        takes = self.options.get("pushFilters", "false").lower() == "true"
        return (FilteringReader if takes else Reader)(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("rows can be added to an external table, not replaced")
        return Writer(dict(self.options), schema)


def read_external(spark: SparkSession, path: str, table: str, **options: Any) -> DataFrame:
    """A table of the store; filters on whole numbers, texts and dates, and tests for null, are applied inside where the session lets them."""
    spark.dataSource.register(ExternalTable)
    options = {"pushFilters": spark.conf.get(PUSHDOWN, "false"), **options}
    return spark.read.format(FORMAT).options(path=path, table=table, **options).load()


class Store:
    """All tables of one external store by name."""

    def __init__(self, spark: SparkSession, path: str, **options: Any) -> None:
        self.spark, self.path, self.options = spark, path, options

    def table(self, name: str, **options: Any) -> DataFrame:
        return read_external(self.spark, self.path, name, **self.options, **options)


def append_external(df: DataFrame, path: str, table: str, **options: Any) -> None:
    """Add the rows of ``df`` as one commit: all of them once, or none."""
    df.sparkSession.dataSource.register(ExternalTable)
    df.write.format(FORMAT).mode("append").options(path=path, table=table, **options).save()
