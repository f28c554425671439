"""Aggregates kept beside a folder table that always agree with it.

Partial aggregates are stored per partition of the base together with a
fingerprint of the partition's files (name, length, time). A read compares the
fingerprints with the listing of the moment, takes the stored rows of unchanged
partitions and computes the others from the base, so no writer has to say what
it touched. :meth:`Projection.refresh` stores what a read would compute.

The listing is made by Spark and reads no file. One row per partition comes to
the driver, as for every change of a folder table.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.operators import tables
from brookmill.operators.tables import Folder

_STATE = "files_state"
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_FIRST = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def fingerprints(folder: Folder) -> DataFrame:
    """Return (partition columns, ``files_state``): per partition its number of files, their bytes and two hashes over all of them."""
    by = list(folder.by)
    kinds = {f.name: f.dataType for f in folder.schema}
    if not tables.exists(folder.spark, folder.path):
        return folder.spark.createDataFrame([], T.StructType([*[T.StructField(c, kinds[c]) for c in by], T.StructField(_STATE, T.StringType())]))
    listed = folder.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder.path)
    parts = F.split("path", "/")
    values = []
    for i, c in enumerate(by):
        text = F.regexp_replace(F.element_at(parts, i - len(by) - 1), "^[^=]*=", "")
        known = F.when(text != tables.NO_VALUE, F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))))
        values.append(known.cast(kinds[c]).alias(c))
    files = listed.select(*values, "length", F.xxhash64("path", "length", "modificationTime").alias("h"))
    hashes = [F.bit_xor(F.col("h")), F.bit_xor(F.xxhash64("h"))]
    return files.groupBy(*by).agg(F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), *hashes).alias(_STATE))


class Projection:
    """``measures`` maps names to (sum, count, min or max; expression) per ``keys``, stored at ``path`` by the partitions of ``base``."""

    def __init__(self, base: Folder, path: str, keys: list[str], measures: dict[str, tuple[str, Column]]) -> None:
        if unknown := {how for how, _ in measures.values()} - set(_MERGE):
            raise ValueError(f"no measure can be kept by {sorted(unknown)}")
        self.base, self.keys, self.measures = base, keys, measures
        self._group = [*keys, *[c for c in base.by if c not in keys]]
        rows = base.spark.createDataFrame([], base.schema)
        schema = self._partials(rows).withColumn(_STATE, F.lit("")).schema
        self.stored = Folder(base.spark, path, T.StructType([T.StructField(f.name, f.dataType) for f in schema]), base.by)

    def _partials(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self._group).agg(*[_FIRST[how](c).alias(n) for n, (how, c) in self.measures.items()])

    def _same_partition(self, a: DataFrame, b: DataFrame) -> Column:
        same = F.lit(True)
        for c in self.base.by:
            same = same & a[c].eqNullSafe(b[c])
        return same

    def _compare(self) -> tuple[list[dict[str, Any]], list[dict[str, Any]]]:
        """Partitions with their fingerprint: those whose stored rows are current, and the others."""
        now = [r.asDict() for r in fingerprints(self.base).collect()]
        key = lambda p: tuple(p[c] for c in (*self.base.by, _STATE))
        held = {key(r.asDict()) for r in self.stored.read().select(*self.base.by, _STATE).distinct().collect()}
        return [p for p in now if key(p) in held], [p for p in now if key(p) not in held]

    def changed(self) -> list[dict[str, Any]]:
        """Partitions that a read computes from the base."""
        return [{c: p[c] for c in self.base.by} for p in self._compare()[1]]

    def _fresh(self, parts: list[dict[str, Any]]) -> DataFrame:
        return self._partials(tables.rows_of(self.base, [{c: p[c] for c in self.base.by} for p in parts]))

    def _marks(self, parts: list[dict[str, Any]]) -> DataFrame:
        kinds = [f for f in self.stored.schema if f.name in (*self.base.by, _STATE)]
        return self.base.spark.createDataFrame([tuple(p[f.name] for f in kinds) for p in parts], T.StructType(kinds))

    def read(self) -> DataFrame:
        """The measures per key over all rows the base has now."""
        current, others = self._compare()
        names = [*self._group, *self.measures]
        partials = self.base.spark.createDataFrame([], self.stored.schema).select(*names)
        if current:
            rows, marks = tables.rows_of(self.stored, [{c: p[c] for c in self.base.by} for p in current]), self._marks(current)
            kept = rows.join(marks, self._same_partition(rows, marks) & (rows[_STATE] == marks[_STATE]), "left_semi")
            partials = partials.unionByName(kept.select(*names))
        if others:
            partials = partials.unionByName(self._fresh(others).select(*names))
        return partials.groupBy(*self.keys).agg(*[_MERGE[how](n).alias(n) for n, (how, _) in self.measures.items()])

    def refresh(self) -> int:
        """Store the rows of changed partitions in place of older ones; returns how many partitions that were.

        The fingerprints are taken before the base is read: rows that arrive in
        between leave a fingerprint that no listing will match.
        """
        _, others = self._compare()
        if others:
            rows, marks = self._fresh(others), self._marks(others)
            marked = rows.join(F.broadcast(marks) if len(others) <= tables.NAMED else marks, self._same_partition(rows, marks))
            columns = [rows[n] for n in (*self._group, *self.measures)] + [marks[_STATE]]
            chosen = marked.select(*columns).select(*self.stored.schema.fieldNames())
            if self.base.by:
                tables.write_partitioned(chosen, self.stored.path, list(self.base.by), "replace_partitions")
            else:
                chosen.write.mode("overwrite").parquet(self.stored.path)
        return len(others)
