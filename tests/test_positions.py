"""Marked rows: deletes and updates that write places, reads that leave them out."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.operators import positions as M
from brookmill.operators import tables as W
from brookmill.scratch import new_path

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("city", T.StringType()), T.StructField("day", T.DateType())])


@pytest.fixture
def folder(spark):
    made = M.MarkedFolder(spark, new_path(spark, "marked"), SCHEMA, ("city", "day"))
    rows = [(i, f"v{i}" if i % 9 else None, [None, "a b", "x/y"][i % 3], dt.date(2024, 1, 1 + i % 2)) for i in range(300)]
    W.append(made, spark.createDataFrame(rows, SCHEMA).repartition(4))
    return made, {r[0]: r for r in rows}


def _rows(folder):
    return {r["id"]: tuple(r) for r in folder.read().collect()}


def _files(spark, path):
    return {r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path").collect()}


def test_deleting_a_row_writes_places_only(spark, folder):
    made, rows = folder
    before = _files(spark, made.path)
    assert M.delete_rows(made, F.col("id") == 17) == 1
    assert M.delete_rows(made, F.col("id") == 17) == 0 and M.delete_rows(made, F.col("id") > 1000) == 0
    del rows[17]
    assert _rows(made) == rows and _files(spark, made.path) == before
    assert M.delete_rows(made, (F.col("v") == "v5") | F.col("city").isNull()) == 101
    rows = {k: r for k, r in rows.items() if r[1] != "v5" and r[2] is not None}
    assert _rows(made) == rows and _files(spark, made.path) == before
    assert made.read().columns == SCHEMA.fieldNames()


def test_partitions_without_notes_are_read_plainly(spark, folder):
    made, _ = folder
    M.delete_rows(made, F.col("id") == 17)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan(made.read().filter(F.col("city") == "a b"))
    assert plan(made.read()).count("Join") == 1 and "Union" in plan(made.read())


def test_updates_move_rows_and_may_be_repeated(spark, folder):
    made, rows = folder
    assert M.update_rows(made, F.col("id").between(10, 19), {"v": F.concat("v", F.lit("!"))}) == 10
    assert M.update_rows(made, F.col("id").between(15, 30), {"city": F.lit("new"), "v": F.lit("w")}) == 16
    for k in range(10, 31):
        i, v, c, d = rows[k]
        rows[k] = (i, "w", "new", d) if k >= 15 else (i, None if v is None else v + "!", c, d)
    assert _rows(made) == rows and made.read().count() == 300


def test_compaction_rewrites_and_drops_the_notes(spark, folder):
    made, rows = folder
    M.delete_rows(made, (F.col("city") == "a b") | (F.col("id") < 40))
    rows = {k: r for k, r in rows.items() if r[2] != "a b" and k >= 40}
    before = _files(spark, made.path)
    assert M.compact(made, share=0.9) == 2 and _rows(made) == rows
    assert M.compact(made) == 4 and M.compact(made) == 0 and _rows(made) == rows
    assert not _files(spark, made.path) & before and not made._noted()
    assert M.delete_rows(made, F.col("id") == 299) == 1 and len(_rows(made)) == len(rows) - 1


def test_notes_on_replaced_files_match_nothing(spark, folder):
    """A run that ended after the rewrite and before the notes were dropped leaves notes on files that are gone."""
    made, rows = folder
    M.delete_rows(made, F.col("id") % 2 == 0)
    kept = {k: r for k, r in rows.items() if k % 2}
    W.write_partitioned(made.read(), made.path, ["city", "day"], "replace_partitions")
    assert made._noted() and _rows(made) == kept


def test_unpartitioned_tables_are_refused(spark):
    plain = M.MarkedFolder(spark, new_path(spark, "plain"), SCHEMA, ())
    with pytest.raises(ValueError, match="partitioned"):
        M.delete_rows(plain, F.lit(True))
