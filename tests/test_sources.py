from __future__ import annotations

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.sources import files as S
from brookmill.sources import jdbc
from brookmill.sources import topics as K
from brookmill.sources.generate import numbers, spread_days, values
from brookmill.sources.tables import union_matching


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_names():
    assert S.table_name("/a/b/MenuItem.csv") == "menu_item" and S.table_name("Dish.csv.gz") == "dish"
    assert S.numbered("trips_{0..2}.gz") == "trips_{0,1,2}.gz"


def test_tables_of_a_folder(spark, path):
    S.write_csv(spark.range(3).coalesce(1), f"{path}/x")
    name = spark.read.format("binaryFile").load(f"{path}/x/*.csv").select("path").first()["path"]
    found = S.read_csv_tables(spark, f"{path}/x", {S.table_name(name): T.StructType.fromDDL("id long")})
    assert len(found) == 1 and next(iter(found.values())).count() == 3


def test_folder_tables_merge_names_and_miss_none(spark, tmp_path):
    for place in ("a", "b"):
        (tmp_path / place).mkdir()
        (tmp_path / place / "MenuItem.csv").write_text(f"id\n{ord(place)}\n")
    schema = T.StructType.fromDDL("id long")
    found = S.read_csv_tables(spark, str(tmp_path), {"menu_item": schema})
    assert rows(found["menu_item"]) == Counter([(97,), (98,)])
    with pytest.raises(FileNotFoundError, match="dish"):
        S.read_csv_tables(spark, str(tmp_path), {"menu_item": schema, "dish": schema})


def test_sensor_files_of_two_headers(spark, path):
    head = "sensor_id;sensor_type;timestamp;P1"
    wide = spark.createDataFrame([(head,), ("1;a;2024-01-01;bad",), ("2;a;;5.0",), ("3;a;2024-01-02;7.5",)], "value string")
    narrow = spark.createDataFrame([("sensor_id;timestamp",), ("4;2024-01-03",), (";2024-01-03",)], "value string")
    wide.coalesce(1).write.text(f"{path}/a")
    narrow.coalesce(1).write.text(f"{path}/b")
    assert S.new_files(spark, path, ".txt", limit=None).count() == 2
    groups = S.group_by_header(spark, path, ["sensor_id", "sensor_type", "timestamp", "P1"])
    assert set(groups) == {("sensor_id", "sensor_type", "timestamp", "P1"), ("sensor_id", "timestamp")}
    schema = T.StructType.fromDDL("sensor_id int, sensor_type string, timestamp string, P1 double")
    got = S.read_sensor_files(spark, groups, schema, ["timestamp", "sensor_id"])
    want = [(1, "a", "2024-01-01", None), (3, "a", "2024-01-02", 7.5), (4, None, "2024-01-03", 0.0)]
    assert rows(got) == Counter(want)


def test_new_files(spark, tmp_path):
    """Rounds of two take every file once, though all changed in one second."""
    times = [1_700_000_000.5] * 3 + [1_700_000_000.0, 1_700_000_000.5, 1_700_000_001.25, 1_700_000_001.25]
    for i, t in enumerate(times):
        file = tmp_path / f"x{i}_BME280.csv"
        file.write_text("a")
        os.utime(file, (t, t))
    (tmp_path / "other_DHT22.csv").write_text("b")
    seen, mark = [], None
    while mark_next := S.last_file(found := S.new_files(spark, str(tmp_path), ".csv", ["bme280"], mark, 2)):
        seen.append([r["path"][-13:] for r in found.collect()])
        mark = mark_next
    assert [len(s) for s in seen] == [2, 2, 2, 1]
    assert sorted(p for s in seen for p in s) == [f"/x{i}_BME280.csv"[-13:] for i in range(7)]


def test_daily_cases(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "US", None), ("2024-01-01", "US", 5), (None, "US", 1), ("2024-01-03", "DE", 7)],
        "date string, location_key string, n int",
    ).withColumn("date", F.col("date").cast("date"))
    got = S.read_daily_cases(df, ["n"], after=dt.date(2024, 1, 1), places=["US"])
    assert rows(got) == Counter([("2024-01-02", "US", 0)])
    assert [r["date"] for r in S.read_daily_cases(df, ["n"], limit=2).collect()] == ["2024-01-01", "2024-01-02"]


def test_json_defaults(spark, path):
    spark.createDataFrame([('{"a":null,"t":[{"x":"1"}]}',), ('{"a":"v","t":[]}',)], "value string").write.text(path)
    got = S.read_json_lines(spark, path, T.StructType.fromDDL("a string, t array<struct<x:string>>"), {"a": ""})
    assert rows(got.select("a", F.size("t"))) == Counter([("", 1), ("v", 0)])


def test_union_matching(spark):
    one, two = spark.sql("select 1 a"), spark.sql("select 2 a, 'x' b")
    got = union_matching({"log_1": one, "log_2": two, "other": spark.sql("select 9 z")}, "^log_")
    assert rows(got) == Counter([(1, None), (2, "x")])
    with pytest.raises(ValueError):
        union_matching({"a": one}, "^b")


def test_jdbc_arguments(spark):
    seen = {}

    def reader(**kw):
        seen.update(kw)
        return spark.range(1)

    jdbc.read_jdbc(spark, "jdbc:x", "t", {"user": "u"}, split=("id", 0, 100, 4), reader=reader)
    assert (seen["column"], seen["numPartitions"], seen["table"]) == ("id", 4, "t")
    jdbc.Database(spark, "jdbc:x", reader=reader).table("v", predicates=["a = 1"])
    assert seen["predicates"] == ["a = 1"] and seen["table"] == "v"
    calls = []
    jdbc.append_jdbc(spark.range(1), "jdbc:x", "t", writer=lambda **kw: calls.append(kw["mode"]))
    assert calls == ["append"]
    with pytest.raises(NotImplementedError):
        jdbc.change_jdbc()


def test_generated_rows(spark):
    assert numbers(spark, 4, {"n2": F.col("number") * 2}).agg(F.sum("n2").alias("s")).first()["s"] == 12
    assert values(spark, [(1, "a")], "i int, s string").count() == 1
    days = spread_days(spark.range(50_000), "2024-01-01", 564, "id").groupBy("date").count()
    sizes = [r["count"] for r in days.collect()]
    assert len(sizes) == 564 and max(sizes) < 2 * min(sizes) + 60


def test_messages_round_trip(spark):
    df = spark.createDataFrame([(1, "US", None)], "n int, location_key string, x string")
    m = K.to_messages(df, K.message_key("location_key", F.lit("2024-01-01 10:00"))).first()
    assert m["key"] == "US_2024-01-01_10:00" and m["value"] == '{"n":1,"location_key":"US","x":null}'
    topic = spark.createDataFrame([("k", '{"n":1}'), ("k", "{broken"), ("k", '{"n":"text"}')], "key string, value string")
    got = K.decode(topic, T.StructType.fromDDL("n int"), keep=["key"])
    assert [r["_corrupt"] is None for r in got.collect()] == [True, False, False]
