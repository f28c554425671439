"""Row changes on a folder table that write positions and new rows, not whole partitions.

A deleted row is noted by (partition, file, place in the file) beside the table.
Readers leave noted rows out: partitions without notes are read as they are, in
the others rows are matched with the notes. An update notes the old rows and
adds the new ones. :func:`compact` rewrites partitions without their deleted
rows and drops the notes.

File names are never used twice, so notes on a file that a rewrite has replaced
match nothing. As with other changes of folder tables there is one writer, and
readers are not isolated from it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.operators import tables
from brookmill.operators.tables import Folder
from brookmill.scratch import cut

_FILE, _ROW = "row_of_file", "row_number"


@dataclass(frozen=True)
class MarkedFolder(Folder):
    """A folder table with notes of deleted rows. Its columns must not be called ``row_of_file`` or ``row_number``."""

    @property
    def notes(self) -> Folder:
        kinds = [f for f in self.schema if f.name in self.by]
        schema = T.StructType([T.StructField(_FILE, T.StringType()), T.StructField(_ROW, T.LongType()), *kinds])
        return Folder(self.spark, f"{self.path}-deleted", schema, self.by)

    @property
    def plain(self) -> Folder:
        """The table with its deleted rows."""
        return Folder(self.spark, self.path, self.schema, self.by)

    def read(self) -> DataFrame:
        return self.located().select(*self.schema.fieldNames())

    def located(self) -> DataFrame:
        """The rows that are not deleted, with file and place."""
        if not tables.exists(self.spark, self.path):
            places = [T.StructField(_FILE, T.StringType()), T.StructField(_ROW, T.LongType())]
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, *places]))
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        rows = rows.select(*self.schema.fieldNames(), F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))
        noted = self._noted()
        if not noted:
            return rows
        inside = tables.in_partitions(self, noted)
        notes = self.notes.read()
        same = (rows[_FILE] == notes[_FILE]) & (rows[_ROW] == notes[_ROW])
        for c in self.by:
            same = same & rows[c].eqNullSafe(notes[c])
        return rows.filter(~inside).unionByName(rows.filter(inside).join(notes, same, "left_anti"))

    def _noted(self) -> list[dict[str, Any]]:
        """Partitions with notes, from folder names alone."""
        return [r.asDict() for r in tables.list_partitions(self.notes).collect()]


def _note(folder: MarkedFolder, places: DataFrame) -> None:
    tables.write_partitioned(places, folder.notes.path, list(folder.by))


def delete_rows(folder: MarkedFolder, condition: Column) -> int:
    """Delete the rows that match; returns how many. Only their places are written."""
    if not folder.by:
        raise ValueError("a table of marked rows is partitioned")
    hits = cut(folder.located().filter(condition).select(_FILE, _ROW, *folder.by), "deleted-rows")
    n = hits.count()
    if n:
        _note(folder, hits)
    return n


def update_rows(folder: MarkedFolder, condition: Column, changes: dict[str, Column]) -> int:
    """Set columns on matching rows; returns how many. Only these rows are written, and may change partition.

    The new rows are found first and added last: a run that fails between has
    deleted rows whose new form is stored in the scratch folder only.
    """
    if not folder.by:
        raise ValueError("a table of marked rows is partitioned")
    kinds = {f.name: f.dataType for f in folder.schema}
    hits = cut(folder.located().filter(condition), "updated-rows")
    n = hits.count()
    if n:
        changed = hits.select(*[changes[c].cast(kinds[c]).alias(c) if c in changes else F.col(c) for c in folder.schema.fieldNames()])
        stored = cut(changed, "updated-rows-new")
        _note(folder, hits.select(_FILE, _ROW, *folder.by))
        tables.append(folder, stored)
    return n


def compact(folder: MarkedFolder, share: float = 0.0) -> int:
    """Rewrite the partitions of which more than ``share`` of the rows are deleted, and drop their notes; returns how many.

    The notes go last: until then they name files that are no longer there.
    """
    if not folder._noted():
        return 0
    kept = tables.rows_of(folder.plain, folder._noted()).groupBy(*folder.by).agg(F.count(F.lit(1)).alias("rows"))
    gone = folder.notes.read().groupBy(*folder.by).agg(F.count(F.lit(1)).alias("deleted"))
    same = F.lit(True)
    for c in folder.by:
        same = same & kept[c].eqNullSafe(gone[c])
    counted = gone.join(kept, same, "left").select(*[gone[c] for c in folder.by], "deleted", "rows")
    due = [r.asDict() for r in counted.filter(F.col("rows").isNull() | (F.col("deleted") > F.col("rows") * share)).collect()]
    parts = [{c: p[c] for c in folder.by} for p in due]
    left = [p for p, d in zip(parts, due, strict=True) if d["rows"] is not None and d["deleted"] < d["rows"]]
    if left:
        tables.write_partitioned(tables.rows_of(folder, left), folder.path, list(folder.by), "replace_partitions")
    for p, d in zip(parts, due, strict=True):
        if d["rows"] is not None and d["deleted"] >= d["rows"]:
            tables.drop_partition(folder.plain, p)
        tables.drop_partition(folder.notes, p)
    return len(parts)
