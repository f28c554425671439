"""The external store as a data source."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from brookmill.plans import load_all
from brookmill.sources import external as X
from tests.compare import connect, difference
from tests.conftest import SMALL

EXTERNAL = "q_ext_by_channel q_ext_cached q_ext_filtered q_ext_join q_ext_since q_ext_three_ways q_ext_totals q_ext_view q_federated_join sink_external_append".split()


@pytest.fixture
def store(spark, path):
    rows = spark.range(0, 5000, 1, 4).select("id", (F.col("id") % 7).cast("int").alias("kind"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("n"), "id")).alias("name"), (F.col("id") * 0.5).alias("x"), F.expr("DATE'2024-01-01' + CAST(id % 50 AS INT)").alias("day"), F.array("id").alias("list"))
    X.append_external(rows, path, "t", groupRows=200)
    return path, rows


def test_rows_types_and_tasks(spark, store):
    path, rows = store
    back = X.read_external(spark, path, "t", taskBytes=1)
    assert back.schema == rows.schema and back.rdd.getNumPartitions() > 20
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


@pytest.mark.parametrize("test", ["id >= 4100", "id = 17 AND kind = 3", "name IS NULL AND id < 90", "name = 'n4999'", "kind IN (1, 2) AND name IS NOT NULL", "x > 2400 AND id < 4900", "day = DATE'2024-01-09'", "id < 0", "name > 'n5' OR id = 3", "NOT (kind = 2)"])
def test_filters_give_the_same_rows(spark, store, test):
    path, rows = store
    got = X.read_external(spark, path, "t").filter(test)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, rows.filter(test).collect()), key=str)


def test_filter_is_inside_the_source(spark, store):
    """With the filter pushed Spark has none of its own, and row groups without a match get no task."""
    path, _ = store
    all_tasks = X.read_external(spark, path, "t", taskBytes=1).rdd.getNumPartitions()
    late = X.read_external(spark, path, "t", taskBytes=1).filter("id >= 4900")
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "").replace("PushedFilters", "") and "id" in plan
    assert late.rdd.getNumPartitions() <= 2 < all_tasks and late.count() == 100


def test_appends_add_up_and_nothing_else_is_allowed(spark, store):
    path, rows = store
    X.append_external(rows.limit(10), path, "t")
    X.append_external(rows.limit(0), path, "t")
    assert X.read_external(spark, path, "t").count() == 5010
    with pytest.raises(Exception, match="not replaced"):
        rows.write.format(X.FORMAT).mode("overwrite").options(path=path, table="t").save()
    with pytest.raises(Exception, match="no table other"):
        X.read_external(spark, path, "other")
    assert X.read_external(spark, path, "t").count() == 5010


def test_a_failed_write_adds_nothing(spark, store):
    path, rows = store
    bad = rows.withColumn("x", F.when(F.col("id") == 4999, F.raise_error(F.lit("broken row")).cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken row"):
        X.append_external(bad, path, "t")
    assert X.read_external(spark, path, "t").count() == 5000


def test_files_of_a_repeated_task_count_once(spark, store):
    """Two attempts of one task leave two files; the commit names the one whose message came back."""
    import pyarrow as pa

    path, rows = store
    writer = X.Writer({"path": path, "table": "t"}, rows.schema)
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in rows.limit(5).collect()], schema=X.to_arrow_schema(rows.schema))
    lost, kept = writer.write(iter([batch])), writer.write(iter([batch]))
    assert lost.name != kept.name and all(os.path.exists(f"{path}/t/data/{m.name}") for m in (lost, kept))
    writer.commit([kept, None])
    assert X.read_external(spark, path, "t").count() == 5005
    other = X.Writer({"path": path, "table": "t"}, rows.schema)
    gone = other.write(iter([batch]))
    other.abort([gone, None])
    assert not os.path.exists(f"{path}/t/data/{gone.name}") and X.read_external(spark, path, "t").count() == 5005
    assert not glob.glob(f"{path}/t/commits/*.tmp")


@pytest.fixture
def plain(spark):
    """The session without the setting that lets filters through."""
    before = spark.conf.get(X.PUSHDOWN)
    spark.conf.set(X.PUSHDOWN, "false")
    yield spark
    spark.conf.set(X.PUSHDOWN, before)


def test_reads_without_pushdown(plain, store):
    """Spark filters then; it would refuse a reader that takes filters."""
    path, rows = store
    got = X.read_external(plain, path, "t").filter("id >= 4100 AND name IS NOT NULL")
    assert "Filter" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.filter("id >= 4100 AND name IS NOT NULL").collect()))
    assert plain.read.format(X.FORMAT).options(path=path, table="t").load().filter("kind = 3").count() == rows.filter("kind = 3").count()


@pytest.mark.parametrize("name", EXTERNAL)
def test_queries_without_pushdown(plain, name):
    assert difference(plain, connect(SMALL), load_all()[name], SMALL) is None
