"""Projections follow their base without being told."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.operators import tables as W
from brookmill.operators.projections import Projection, fingerprints
from brookmill.scratch import new_path

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType()), T.StructField("city", T.StringType()), T.StructField("day", T.DateType())])
NAMES = ["total", "n", "low", "high"]


def _measures():
    return {name: (how, F.col("v")) for name, how in zip(NAMES, ("sum", "count", "min", "max"))}



@pytest.fixture(params=[("city", "day"), ("city",), ()])
def kept(request, spark):
    base = W.Folder(spark, new_path(spark, "base"), SCHEMA, request.param)
    cities = ["Ulm", "St. Gallen/CH", "A+B=C %41", None]
    rows = [(i % 5, None if i % 11 == 0 else i, cities[i % 4], dt.date(2024, 1, 1 + i % 3)) for i in range(120)]
    frame = spark.createDataFrame(rows, SCHEMA)
    if request.param:
        W.append(base, frame)
    else:
        frame.write.parquet(base.path)
    return base, Projection(base, new_path(spark, "kept"), ["k"], _measures())


def _plain(base):
    return sorted(map(tuple, base.read().groupBy("k").agg(F.sum("v"), F.count("v"), F.min("v"), F.max("v")).collect()))


def _got(projection):
    return sorted(map(tuple, projection.read().select("k", *NAMES).collect()))


def test_every_read_agrees(kept):
    base, projection = kept
    partitions = fingerprints(base).count()
    assert partitions == {2: 12, 1: 4, 0: 1}[len(base.by)]
    assert len(projection.changed()) == partitions and _got(projection) == _plain(base)
    assert projection.refresh() == partitions and projection.refresh() == 0 and projection.changed() == []
    assert _got(projection) == _plain(base)
    more = base.spark.createDataFrame([(9, 1000, "Ulm", dt.date(2024, 1, 1)), (1, 7, "new", dt.date(2024, 2, 1))], SCHEMA)
    if not base.by:
        more.write.mode("append").parquet(base.path)
        assert len(projection.changed()) == 1 and _got(projection) == _plain(base)
        return
    W.append(base, more)
    assert len(projection.changed()) == 2 and _got(projection) == _plain(base)
    W.update_where(base, F.col("city").isNull() & (F.col("v") > 50), {"v": F.col("v") * 2})
    assert _got(projection) == _plain(base)
    assert projection.refresh() > 2 and _got(projection) == _plain(base)
    W.delete_where(base, (F.col("city") == "A+B=C %41") | (F.col("v") < 20))
    assert _got(projection) == _plain(base)
    W.drop_partition(base, {"city": "Ulm"})
    assert _got(projection) == _plain(base) and projection.refresh() >= 0 and _got(projection) == _plain(base)


def test_unchanged_partitions_are_not_scanned(spark):
    base = W.Folder(spark, new_path(spark, "base"), SCHEMA, ("day",))
    W.append(base, spark.createDataFrame([(i % 5, i, "x", dt.date(2024, 1, 1 + i % 9)) for i in range(90)], SCHEMA))
    projection = Projection(base, new_path(spark, "kept"), ["k"], _measures())
    projection.refresh()
    W.update_where(base, F.col("day") == dt.date(2024, 1, 4), {"v": F.lit(1).cast("long")})
    scans = projection.read()._jdf.queryExecution().executedPlan().toString().split("FileScan")[1:]
    of_base = [f for f in scans if "ReadSchema: struct<k:bigint,v:bigint>" in f]
    named = of_base[0].split("PartitionFilters: [")[1].split("]")[0]
    assert len(of_base) == 1 and "2024-01-04" in named and "2024-01-05" not in named
    projection.refresh()
    assert "ReadSchema: struct<k:bigint,v:bigint>" not in projection.read()._jdf.queryExecution().executedPlan().toString()


def test_a_missing_base_is_empty_and_unknown_measures_are_refused(spark):
    base = W.Folder(spark, new_path(spark, "none"), SCHEMA, ("day",))
    projection = Projection(base, new_path(spark, "kept"), ["k"], _measures())
    assert projection.read().count() == 0 and projection.refresh() == 0
    with pytest.raises(ValueError, match="median"):
        Projection(base, new_path(spark, "kept"), ["k"], {"m": ("median", F.col("v"))})
