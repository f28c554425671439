"""Row, partition and schema changes on a stored table."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.operators import rollups as R
from brookmill.operators import tables as W

MENU = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("price", T.FloatType()),
        T.StructField("available", T.ShortType()),
        T.StructField("category", T.StringType()),
    ]
)
DISHES = [
    (1, "Caesar", 350.0, 1, "Salad"),
    (2, "Borscht", 290.0, 1, "Soup"),
    (3, "Pizza", 550.0, 0, "Pizza"),
    (4, "Cappuccino", None, 1, "Drinks/hot"),
    (5, "Steak", 1200.0, 1, "Main: grill"),
]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def menu(spark, path):
    folder = W.Folder(spark, path, MENU, ("category",))
    W.append(folder, spark.createDataFrame(DISHES, "id int, name string, price float, available int, category string"))
    return folder


def test_append_round_trip(menu):
    assert rows(menu.read()) == Counter(DISHES)


def test_append_needs_all_columns(menu, spark):
    with pytest.raises(ValueError):
        W.append(menu, spark.createDataFrame([(1,)], "id int"))


def test_update_and_delete(menu):
    assert W.update_where(menu, F.col("name") == "Caesar", {"price": F.lit(360.0)}) == 1
    assert W.delete_where(menu, F.col("id") == 3) == 1
    got = {r["id"]: r["price"] for r in menu.read().collect()}
    assert got == {1: 360.0, 2: 290.0, 4: None, 5: 1200.0}
    # The partition that lost its only row is gone, not left as it was.
    assert rows(W.list_partitions(menu)) == Counter([("Salad",), ("Soup",), ("Drinks/hot",), ("Main: grill",)])


def test_null_condition_does_not_delete(menu):
    W.delete_where(menu, F.col("price") > 1000)
    assert sorted(r["id"] for r in menu.read().collect()) == [1, 2, 3, 4]
    assert W.delete_where(menu, F.col("price") > 10_000) == 0
    assert W.update_where(menu, F.col("id") == 99, {"price": F.lit(1.0)}) == 0


def test_update_in_partition_with_special_name(menu):
    W.update_where(menu, F.col("id") >= 4, {"name": F.concat("name", F.lit("!"))})
    assert {r["name"] for r in menu.read().filter("id >= 4").collect()} == {"Cappuccino!", "Steak!"}
    assert menu.read().count() == 5


def test_partition_column_is_not_updatable(menu):
    with pytest.raises(ValueError):
        W.update_where(menu, F.col("id") == 1, {"category": F.lit("x")})


@pytest.mark.parametrize("named", [0, 1_000])
def test_changes_are_the_same_named_or_joined(menu, spark, monkeypatch, named):
    monkeypatch.setattr(W, "NAMED", named)
    assert W.update_where(menu, F.col("price") > 300, {"price": F.col("price") + 1}) == 3
    assert W.delete_where(menu, F.lit(True)) == 5
    assert menu.read().count() == 0


def test_empty_text_as_partition_value_is_refused(menu, spark):
    with pytest.raises(Exception, match="empty text in partition column"):
        W.append(menu, spark.createDataFrame([(9, "x", 1.0, 1, "")], MENU))


@pytest.mark.parametrize("name", ["Salad", "Drinks/hot", "Main: grill"])
def test_drop_partition(menu, name):
    assert W.drop_partition(menu, {"category": name})
    assert menu.read().count() == 4 and menu.read().filter(F.col("category") == name).count() == 0
    assert not W.drop_partition(menu, {"category": name})


def test_replace_partition(menu, spark):
    new = spark.createDataFrame([(9, "Gazpacho", 310.0, 1, "Soup"), (8, "Other", 1.0, 1, "Salad")], MENU)
    W.replace_partition(menu, {"category": "Soup"}, new)
    assert sorted(r["id"] for r in menu.read().collect()) == [1, 3, 4, 5, 9]
    W.replace_partition(menu, {"category": "Soup"}, new.filter("id < 0"))
    assert sorted(r["id"] for r in menu.read().collect()) == [1, 3, 4, 5]


def test_null_partition(spark, path):
    folder = W.Folder(spark, path, T.StructType.fromDDL("id int, p string"), ("p",))
    W.append(folder, spark.createDataFrame([(1, None), (2, "a")], "id int, p string"))
    W.update_where(folder, F.col("id") == 1, {"id": F.lit(10)})
    assert rows(folder.read()) == Counter([(10, None), (2, "a")])
    W.delete_where(folder, F.col("id") == 10)
    assert rows(folder.read()) == Counter([(2, "a")])


def test_two_partition_columns(spark, path):
    folder = W.Folder(spark, path, T.StructType.fromDDL("id int, y int, m int"), ("y", "m"))
    W.append(folder, spark.createDataFrame([(i, 2024 + i % 2, i % 3) for i in range(12)], "id int, y int, m int"))
    W.update_where(folder, (F.col("y") == 2024) & (F.col("id") == 4), {"id": F.lit(400)})
    W.delete_where(folder, (F.col("y") == 2025) & (F.col("m") == 1))
    ids = sorted(r["id"] for r in folder.read().collect())
    assert ids == sorted([400 if i == 4 else i for i in range(12) if not (i % 2 == 1 and i % 3 == 1)])
    W.drop_partition(folder, {"y": 2024})
    assert folder.read().filter("y = 2024").count() == 0


def test_columns_added_and_dropped(menu, spark):
    new = {"calories": ("int", 0), "is_vegan": ("int", 0)}
    gone = ("available",)
    later = T.StructType([f for f in MENU if f.name != "available"] + [T.StructField("calories", T.IntegerType())])
    W.append(
        W.Folder(spark, menu.path, later, ("category",)),
        spark.createDataFrame([(6, "Gazpacho", 310.0, "Soup", 80)], "id int, name string, price float, category string, calories int"),
    )
    got = {r["id"]: r for r in W.evolved(menu, new, gone).collect()}
    assert set(got[1].asDict()) == {"id", "name", "price", "category", "calories", "is_vegan"}
    assert (got[1]["calories"], got[6]["calories"], got[6]["is_vegan"]) == (0, 80, 0)
    assert "price" not in W.drop_columns(menu.read(), "price").columns


def test_expire_keeps_the_cutoff(spark, path):
    schema = T.StructType.fromDDL("ts timestamp_ntz, day int")
    folder = W.Folder(spark, path, schema, ("day",))
    times = [dt.datetime(2024, 1, d, h) for d in (1, 2, 3) for h in (0, 11, 12, 13)]
    W.append(folder, spark.createDataFrame([(t, t.day) for t in times], schema))
    W.expire(folder, "ts", 7, dt.datetime(2024, 1, 9, 12))
    left = sorted(r["ts"] for r in folder.read().collect())
    assert left == [t for t in times if t >= dt.datetime(2024, 1, 2, 12)]
    assert rows(W.list_partitions(folder)) == Counter([(2,), (3,)])


def test_expire_by_day_reads_only_the_cutoff_day(spark, path):
    days = [dt.datetime(2024, 1, d, h) for d in (1, 2, 3) for h in (6, 18)]
    data = spark.createDataFrame([(i, d, 20240100 + d.day) for i, d in enumerate(days)], "id int, ts timestamp_ntz, day int")
    folder = W.Folder(spark, path, data.schema, ("day",))
    W.append(folder, data)
    for file in spark.read.format("binaryFile").load(f"{path}/day=20240101/*").select("path").collect():
        local = file["path"].removeprefix("file:")
        open(local, "wb").write(b"unreadable")
    assert W.expire(folder, "ts", 7, dt.datetime(2024, 1, 9, 12), day_number="day") == 2
    assert sorted(r["id"] for r in folder.read().collect()) == [3, 4, 5]
    assert sorted(r["day"] for r in W.list_partitions(folder).collect()) == [20240102, 20240103]


def test_attach_moves_no_rows(spark, path):
    data = spark.range(100).selectExpr("id", "CAST(id % 5 AS INT) AS k")
    source = W.Folder(spark, f"{path}/a", data.schema, ("k",))
    W.append(source, data)
    clone = W.Folder(spark, f"{path}/b", data.schema, ("k",))
    assert "Exchange" not in W._checked(clone, source.read())._jdf.queryExecution().executedPlan().toString()
    W.attach_all(clone, source)
    assert rows(clone.read()) == rows(source.read())


def test_partition_guard(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 AS k")
    assert W.require_few_partitions(df, ["k"]) == 7
    with pytest.raises(ValueError):
        W.require_few_partitions(df, ["id"])


def test_chunks(spark, path):
    df = spark.range(1000).selectExpr("id", "id * 2 AS v")
    W.write_chunks(df, path, "id", 4)
    W.write_chunks(df.withColumn("v", F.lit(-1).cast("long")), path, "id", 4, only=[1])
    got = spark.read.parquet(path)
    assert got.count() == 1000 and got.select("id").distinct().count() == 1000
    assert {r["chunk"] for r in got.filter("v = -1").select("chunk").distinct().collect()} == {1}


def test_clustered_write_splits_a_hot_key(spark, path):
    df = spark.range(20_000).selectExpr("CASE WHEN id < 15000 THEN 1 ELSE id END AS k", "id")
    W.write_clustered(df, path, ["k"], files=8)
    sizes = spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).count().collect()
    assert len(sizes) >= 7 and max(r["count"] for r in sizes) < 6000


def _sales_rollup(spark, path):
    rollup = R.Rollup(spark, path, "month", ["product"], {"quantity": F.col("quantity")})
    frame = lambda *data: spark.createDataFrame(list(data), "product int, quantity int, month int")
    return rollup, frame, lambda: {r["product"]: r["quantity"] for r in rollup.read().collect()}


def test_rollup_replay_after_compaction(spark, path):
    rollup, frame, totals = _sales_rollup(spark, path)
    a = frame((1, 10, 202401), (2, 5, 202402))
    rollup.add_batch(a, "A")
    rollup.add_batch(frame((1, 1, 202401)), "B")
    rollup.compact([202401, 202402])
    assert totals() == {1: 11, 2: 5}
    rollup.add_batch(a, "A")
    assert totals() == {1: 11, 2: 5}
    rollup.add_batch(frame((1, 100, 202401), (3, 7, 202403)), "C")
    assert totals() == {1: 111, 2: 5, 3: 7}
    rollup.compact([202401])
    rollup.add_batch(frame((1, 1, 202401)), "B")
    assert totals() == {1: 111, 2: 5, 3: 7}
    rollup.rebuild(frame((1, 50, 202401)), [202401])
    assert totals() == {1: 50, 2: 5, 3: 7}
    again, _, _ = _sales_rollup(spark, path)
    assert {r["product"]: r["quantity"] for r in again.read(periods=[202401]).collect()} == {1: 50}


def test_corrected_batch_leaves_nothing_behind(spark, path):
    rollup, frame, totals = _sales_rollup(spark, path)
    rollup.add_batch(frame((1, 10, 202401), (2, 5, 202402)), "A")
    rollup.add_batch(frame((1, 10, 202401)), "A")
    assert totals() == {1: 10}


def test_failed_compaction_changes_nothing(spark, path, monkeypatch):
    rollup, frame, totals = _sales_rollup(spark, path)
    rollup.add_batch(frame((1, 10, 202401)), "A")
    rollup.add_batch(frame((1, 3, 202401)), "B")
    write = W.write_partitioned

    def half(df, target, *args):
        write(df, target, *args)
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(W, "write_partitioned", half)
    with pytest.raises(RuntimeError):
        rollup.compact([202401])
    with pytest.raises(RuntimeError):
        rollup.rebuild(frame((1, 99, 202401)), [202401])
    monkeypatch.setattr(W, "write_partitioned", write)
    assert totals() == {1: 13}
    rollup.compact([202401])
    assert totals() == {1: 13}


def test_rollup_replay_backfill_drift(spark, path):
    sums = {"total": F.col("quantity"), "amount": F.col("quantity") * F.col("price")}
    rollup = R.Rollup(spark, path, "month", ["product"], sums)
    base = spark.createDataFrame([(1, 10, 2.0, 202312), (2, 1, 5.0, 202311), (1, 4, 1.0, 202311)], "product int, quantity int, price double, month int")
    rollup.add_batch(base.filter("month = 202312"), "b1")
    rollup.add_batch(base.filter("month = 202312"), "b1")
    rollup.backfill(base, F.col("month") == 202311)
    want = Counter([(1, 14, 24.0), (2, 1, 5.0)])
    assert rows(rollup.read()) == want
    assert rows(rollup.read(periods=[202312])) == Counter([(1, 10, 20.0)])
    # A row comes, is repriced, then deleted: the view keeps what came.
    rollup.add_batch(spark.createDataFrame([(1, 5, 200.0, 202312)], base.schema), "b2")
    now = R.merge_sums(R.sum_states(base, ["product"], sums), ["product"], list(sums))
    off = R.drift(now, rollup.read(), ["product"], list(sums)).first()
    assert (off["product"], off["view_total"] - off["base_total"], off["view_amount"] - off["base_amount"]) == (1, 5, 1000.0)
    rollup.rebuild(base, [202312])
    assert rows(rollup.read()) == want
    assert R.drift(now, rollup.read(), ["product"], list(sums)).isEmpty()
    rollup.compact([202311, 202312])
    assert rows(rollup.read()) == want


def test_drift_sees_missing_keys(spark):
    a = spark.createDataFrame([(1, 1.0)], "k int, v double")
    b = spark.createDataFrame([(2, 1.0)], "k int, v double")
    assert {r["k"] for r in R.drift(a, b, ["k"], ["v"]).collect()} == {1, 2}
