from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brookmill.operators import aggregates as A
from brookmill.operators import checks as C
from brookmill.operators import joins as J
from brookmill.operators.filters import between_days, limit_then_filter, non_zero_point, where_in
from brookmill.operators.gapfill import fill_gaps


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def films(spark):
    return (
        spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "D"), (None, "E")], "id int, name string"),
        spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, ""), (3, None), (None, "z")], "movie int, genre string"),
    )


def test_left_distinct_keeps_unmatched(films):
    got = J.left_distinct(*films, "id", "movie", "genre").select("name", "genre")
    assert rows(got) == Counter([("A", "x"), ("A", "y"), ("B", ""), ("C", ""), ("D", ""), ("E", "")])


def test_left_where_empty(films):
    got = J.left_where_empty(*films, "id", "movie", "genre").select("name")
    assert rows(got) == Counter([("B",), ("C",), ("D",), ("E",)])


def test_without_match(films):
    assert rows(J.without_match(*films, "id", "movie").select("name")) == Counter([("D",), ("E",)])


def test_lookup_default(spark):
    d = spark.createDataFrame([(1002, "user1002@example.com")], "user_id long, email string")
    df = spark.createDataFrame([(1, 1002), (2, 7), (3, None)], "i int, user long")
    got = J.lookup(df, d, "user", "user_id", {"email": ""})
    assert rows(got.select("i", "email")) == Counter([(1, "user1002@example.com"), (2, ""), (3, "")])


@pytest.mark.parametrize("k", [1, 3, 7, 50])
def test_product_top_equals_full_product(spark, k):
    a = [("m", 1), ("m", 2), ("n", 3), ("b", 4)]
    b = ["y", "x", "x", "z"]
    left = spark.createDataFrame(a, "name string, i int").select("name")
    right = spark.createDataFrame([(g,) for g in b], "genre string")
    got = [tuple(r) for r in J.product_top(left, right, ["name"], ["genre"], k).collect()]
    assert got == sorted((m, g) for m, _ in a for g in b)[:k]


def test_product_top_with_empty_side(spark):
    left = spark.createDataFrame([("a",)], "name string")
    right = spark.createDataFrame([], "genre string")
    assert J.product_top(left, right, ["name"], ["genre"], 5).count() == 0


def test_collect_parts_is_whole_and_bounded(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    parts = A.collect_parts(df, ["k"], "id", ["id"], part_rows=100, out="v").collect()
    hot = [p for p in parts if p["k"] == "hot"]
    assert sorted(p["part"] for p in hot) == list(range(7)) and all(len(p["v"]) == 100 for p in hot)
    assert sorted(x for p in hot for x in p["v"]) == list(range(700))
    assert all(p["part"] == 0 for p in parts if p["k"] != "hot") and len(parts) == 307


def test_correlations_order(spark):
    df = spark.createDataFrame([(float(i), float(-2 * i), float(i % 3)) for i in range(30)], "a double, b double, c double")
    got = A.correlations(df, {"A": "a", "B": "b", "C": "c"}, 4).collect()
    assert (got[0]["param_x"], got[0]["param_y"], got[0]["correlation"]) == ("A", "B", -1.0) and len(got) == 3


def test_avg_if_without_rows_is_zero(spark):
    df = spark.createDataFrame([(1, "a", 4.0), (1, "b", 8.0)], "k int, n string, v double")
    r = df.groupBy("k").agg(A.avg_if("v", F.col("n") == "a").alias("x"), A.avg_if("v", F.col("n") == "z").alias("y")).first()
    assert (r["x"], r["y"]) == (4.0, 0.0)


def test_fill_gaps(spark):
    one = spark.createDataFrame([(600, "h", 1.0)], "t long, host string, v double")
    assert rows(fill_gaps(one, "t", 60, {"host": "", "v": 0.0})) == Counter([(600, "h", 1.0)])
    two = spark.createDataFrame([(0, "a", 1.0), (0, "b", 2.0), (180, "a", 3.0)], "t long, host string, v double")
    want = [(0, "a", 1.0), (0, "b", 2.0), (180, "a", 3.0), (60, "", 0.0), (120, "", 0.0)]
    assert rows(fill_gaps(two, "t", 60, {"host": "", "v": 0.0})) == Counter(want)
    per = fill_gaps(two, "t", 60, {"v": 0.0}, per=["host"])
    assert per.count() == 8 and per.filter("host = 'b' and v = 0.0").count() == 3


def test_fill_gaps_longer_than_a_block(spark):
    ends = spark.createDataFrame([(0, 1), (10_000, 1)], "t long, n long")
    filled = fill_gaps(ends, "t", 1, {"n": 0})
    assert filled.count() == 10_001 and filled.agg(F.countDistinct("t").alias("d")).first()["d"] == 10_001


def test_fill_gaps_empty(spark):
    assert fill_gaps(spark.createDataFrame([], "t long, n long"), "t", 60, {"n": 0}).count() == 0


def test_filters(spark):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i, 12)) for i in range(5)], "i int, d timestamp_ntz")
    assert where_in(df, "i", []).count() == 5 and where_in(df, "i", [1, 9]).count() == 1
    assert between_days(df, "d", dt.date(2024, 1, 2), dt.date(2024, 1, 3)).count() == 2
    assert between_days(df, "d", last=dt.date(2024, 1, 1)).count() == 1
    assert limit_then_filter(df, ["i"], 3, F.col("i") >= 2).count() == 1
    pts = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0), (1.0, 1.0)], "lat double, lon double")
    assert pts.filter(non_zero_point()).count() == 1


def test_checks(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert rows(C.differing_rows(a, b)) == Counter([(1, 1, "left"), (3, -1, "right")])
    assert C.differing_rows(a, a).isEmpty()
    assert rows(C.duplicate_keys(a, ["x"])) == Counter([(1, 2)])
    batches = spark.createDataFrame([(10, 10), (10, 4), (10, 0), (0, 0)], "e int, s int")
    got = [r["validation_status"] for r in C.completeness(batches, "e", "s").collect()]
    assert got == ["success", "partial", "failed", "success"]
    with pytest.raises(ValueError):
        C.require_flow(spark.createDataFrame([], "x int"), "x")
    with pytest.raises(ValueError):
        C.require_loaded(C.validate_load(spark.createDataFrame([], "c string, p double"), "c", "p", 2, F.lit("all"), "c"))


def test_load_report(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "c string, p double")
    got = C.validate_load(df, "c", "p", 2, F.lit("m1"), "c")
    assert rows(got.filter("section = 'category'")) == Counter([("category", "a", 2, 2.0), ("category", "b", 1, None)])
    assert rows(got.filter("section = 'total'")) == Counter([("total", "", 3, 2.0)])
    assert got.filter("section = 'shard'").agg(F.sum("records").alias("n")).first()["n"] == 3
    C.require_loaded(got)
