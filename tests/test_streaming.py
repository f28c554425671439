from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.scratch import new_path
from brookmill.streaming import dedup, ingest, marks
from brookmill.streaming import typing as Ty
from brookmill.streaming.alerts import threshold_alerts


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_typing_by_field_name(spark):
    df = spark.createDataFrame([("2024-01-02", "2024-01-02 03:04:05", "2024-01-02", 5)], "date string, created_at string, other string, event_date int")
    got = Ty.typed_select(df)
    assert [f.dataType.typeName() for f in got.schema] == ["date", "timestamp", "string", "integer"]


def test_broken_messages(spark):
    decoded = spark.createDataFrame([(1, None), (None, "{x"), (None, "{y")], "n int, _corrupt string")
    good, bad = Ty.split_corrupt(decoded)
    assert good.count() == 1 and bad.count() == 2
    assert Ty.require_few_corrupt(decoded, limit=2).count() == 1
    with pytest.raises(ValueError):
        Ty.require_few_corrupt(decoded, limit=1)


def test_unparsed_rows_go_aside(spark):
    df = spark.createDataFrame([("2024-01-01",), ("never",), ("",), (None,)], "raw string")
    good, bad = Ty.split_unparsed(df.withColumn("d", F.try_to_date("raw", "yyyy-MM-dd")), "raw", "d")
    assert good.count() == 3 and rows(bad.select("raw")) == Counter([("never",)])
    assert Ty.non_empty_dates(df, "raw").count() == 2


def test_normalise(spark):
    df = spark.createDataFrame([("2024-01-01", None, None), (None, 1.0, "a"), ("", 1.0, "a")], "timestamp string, p1 double, kind string")
    got = Ty.normalise(df, "timestamp", ["p1"], {"kind": ""}).collect()
    assert len(got) == 1 and got[0]["p1"] == 0.0 and got[0]["kind"] == "" and len(got[0]["record_hash"]) == 64


def test_alert_threshold_is_exclusive(spark):
    now = dt.datetime(2024, 1, 10, 8)
    data = [("A", dt.date(2024, 1, 9), 600), ("A", dt.date(2024, 1, 10), 400), ("B", dt.date(2024, 1, 9), 1001), ("C", dt.date(2024, 1, 8), 5000)]
    got = threshold_alerts(spark.createDataFrame(data, "k string, d date, n int"), "k", "d", "n", 1000, now).collect()
    assert [(r["location_key"], r["threshold_value"], r["actual_value"], r["message"]) for r in got] == [
        ("B", 1000, 1001, "High daily cases in B: 1001")
    ]


def test_marks_lose_nothing(spark):
    day = dt.date(2024, 1, 1)
    data = [(i, day + dt.timedelta(days=i // 10)) for i in range(45)]
    src = spark.createDataFrame(data, "id int, d date")
    out, mark = new_path(spark, "out"), new_path(spark, "mark")
    steps = []
    while n := marks.load_step(src, "d", "id", out, mark, limit=8):
        steps.append(n)
    assert len(steps) > 2 and sum(steps) == 45
    # A row that arrives late for the last day is still newer than the mark.
    late = src.unionByName(spark.createDataFrame([(45, data[-1][1])], src.schema))
    assert marks.load_step(late, "d", "id", out, mark) == 1
    assert marks.load_step(late, "d", "id", out, mark) == 0
    got = spark.read.schema(src.schema).parquet(out).select("id", "d")
    assert rows(got) == Counter(data + [(45, data[-1][1])])


@pytest.mark.parametrize("limit", [None, 1, 100])
def test_rows_without_mark_stay_out_at_any_limit(spark, limit):
    src = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, None), (3, dt.date(2024, 1, 2))], "id int, d date")
    out, mark = new_path(spark, "out"), new_path(spark, "mark")
    total = 0
    while n := marks.load_step(src, "d", "id", out, mark, limit=limit):
        total += n
    assert total == 2
    assert [r["id"] for r in marks.rows_without_mark(src, "d").collect()] == [2]


def test_manual_mark(spark):
    src = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i)) for i in range(5)], "id int, d date")
    out, mark = new_path(spark, "out"), new_path(spark, "mark")
    assert marks.load_step(src, "d", "id", out, mark) == 5
    assert marks.load_step(src, "d", "id", out, mark, manual=dt.date(2024, 1, 3)) == 2


SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _feed(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _t(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def test_restart_adds_nothing_and_continues(spark):
    src, out, cp = (new_path(spark, n) for n in ("src", "out", "cp"))
    _feed(spark, src, [(1, _t(1), "a", 1.0), (2, _t(2), "b", 2.0)])

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        ingest.to_table(stream, out, cp, ["kind"])
        return spark.read.schema(SCHEMA).parquet(out).count()

    assert run() == 2 and run() == 2
    _feed(spark, src, [(3, _t(3), "a", 3.0)])
    assert run() == 3


def test_batch_replay_is_idempotent(spark, path):
    write = ingest.batch_writer(path)
    df = spark.createDataFrame([(1, _t(1), "a", 1.0)], SCHEMA)
    write(df, 0)
    write(df, 0)
    write(df, 1)
    assert spark.read.parquet(path).count() == 2


def test_stream_hours_match_batch(spark):
    src, out, cp = (new_path(spark, n) for n in ("src", "out", "cp"))
    data = [(i, _t(i // 4, 15 * (i % 4)), "ab"[i % 2], float(i)) for i in range(40)]
    _feed(spark, src, data)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    hours = ingest.hourly(stream, "ts", ["kind"], {"n": F.count(F.lit(1))}, late="1 hour")
    ingest.to_table(hours, out, cp, ["kind"])
    got = {(r["hour"].hour, r["kind"]): r["n"] for r in spark.read.parquet(out).collect()}
    # The newest row is 09:45, so hours up to 07:00-08:00 are closed.
    assert got == {(h, k): 2 for h in range(8) for k in "ab"}


def test_stream_dedup_forgets_after_memory(spark):
    src, out, cp = (new_path(spark, n) for n in ("src", "out", "cp"))
    same = ("a", 1.0)
    _feed(spark, src, [(1, _t(1), *same), (1, _t(1), *same), (2, _t(2), *same)])

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        ingest.to_table(dedup.drop_repeats_stream(stream, "ts", ["id"], "7 days"), out, cp, ["kind"])
        return sorted(r["id"] for r in spark.read.parquet(out).collect())

    assert run() == [1, 2]
    _feed(spark, src, [(1, _t(5), *same), (3, _t(6), *same)])
    assert run() == [1, 2, 3]


def test_audit_and_lag(spark):
    df = spark.createDataFrame([(1, 3, 77, _t(1))], "id int, partition int, offset long, timestamp timestamp")
    r = ingest.audit_columns(df, "b1", "g", dt.datetime(2024, 1, 1, 1, 0, 30)).first()
    assert (r["batch_id"], r["kafka_partition"], r["kafka_offset"], r["lag_seconds"], r["consumer_group_id"]) == ("b1", 3, 77, 30, "g")


def test_dictionary_is_read_anew(spark, path):
    versions = iter(["old", "new"])
    transform = ingest.refreshed(lambda: spark.sql(f"select '{next(versions)}' v"), lambda df, d: df.join(d))
    df = spark.range(1)
    assert [transform(df, i).first()["v"] for i in range(2)] == ["old", "new"]


def test_stream_to_topic(spark):
    from brookmill.sources import topics as K

    src, out, cp = (new_path(spark, n) for n in ("src", "topic", "cp"))
    _feed(spark, src, [(1, _t(1), "a", 1.0), (2, _t(2), "b", 2.0)])
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    messages = K.to_messages(stream, K.message_key("kind", F.col("id").cast("string")), ["id", "kind"])
    ingest.to_topic(messages, "parquet", cp, path=out)
    got = spark.read.parquet(out).select("key", "value")
    assert rows(got) == Counter([("a_1", '{"id":1,"kind":"a"}'), ("b_2", '{"id":2,"kind":"b"}')])


def test_rollup_opened_again(spark):
    from brookmill.operators.rollups import Rollup

    at = new_path(spark, "rollup")
    make = lambda: Rollup(spark, at, "ym", ["kind"], {"total": F.col("value")})
    df = spark.createDataFrame([("a", 1.0, 202401), ("a", 2.0, 202402)], "kind string, value double, ym int")
    make().add_batch(df, "1")
    assert rows(make().read()) == Counter([("a", 3.0)])
