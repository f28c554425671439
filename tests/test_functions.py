from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brookmill.functions import business as B
from brookmill.functions import dates as D
from brookmill.functions import hashing as H
from brookmill.functions import text as X
from brookmill.functions import types as Y


def col(spark, values, kind, expr):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_sql_classification(spark):
    assert col(spark, [100.0, 99.99, None], "double", B.classify_transaction_simple) == ["high_value", "low_value", "low_value"]


PURCHASES = [
    (1001.0, 1, 501, 1, "large_purchase"),
    (1000.0, 1, 511, 500, "rare_product"),
    (1.0, 1, 510, 120, "frequent_buyer"),
    (1.0, 1, 510, 121, "regular"),
    (600.0, 2, 600, 1, "large_purchase"),
    (None, 1, 1, 1, None),
]


@pytest.mark.parametrize("in_sql", [False, True])
def test_classify_transaction(spark, in_sql):
    df = spark.createDataFrame(PURCHASES, "p double, q int, product long, user long, want string")
    B.register_sql_functions(spark)
    got = F.call_function("classify_transaction", F.col("p"), F.col("q").cast("double"), F.col("product"), F.col("user")) if in_sql else B.classify_transaction("p", "q", "product", "user")
    for r in df.select("want", got.alias("got")).collect():
        assert r["got"] == r["want"]


def test_detect_fraud(spark):
    sat, mon = dt.date(2024, 6, 1), dt.date(2024, 6, 3)
    rows = [(2001.0, 591, sat), (2001.0, 591, mon), (2000.0, 591, sat), (2001.0, 590, sat), (2001.0, 591, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, p double, n long, d date")
    got = [r["o"] for r in df.select("i", B.detect_fraud("p", "n", "d").alias("o")).orderBy("i").collect()]
    assert got == ["potential_fraud", "ok", "ok", "ok", None]


def test_total_cost(spark):
    df = spark.range(5).select(B.total_cost(F.col("id") + 1.0, F.col("id") * 2).alias("c")).orderBy("c")
    assert [r["c"] for r in df.collect()] == [0, 4, 12, 24, 40]
    assert col(spark, [1], "long", B.labelled_value) == ["Value 1"]


def test_sql_functions(spark):
    names = B.register_sql_functions(spark)
    assert "detect_fraud" in names
    r = spark.sql("SELECT total_cost(2.5D, 3D) a, classify_transaction(1D, 1D, 511, 1) b, labelled_value(7) c").first()
    assert (r["a"], r["b"], r["c"]) == (7.5, "rare_product", "Value 7")


def test_year_and_month_three_ways(spark):
    df = spark.sql("select date'2024-06-01' d").withColumn("s", F.col("d").cast("string"))
    r = df.select(
        F.substring("s", 1, 4), F.substring("s", 6, 2), X.split_at("s", "-", 1), X.split_at("s", "-", 2), F.year("d"), F.month("d")
    ).first()
    assert tuple(r) == ("2024", "06", "2024", "06", 2024, 6)


def test_parse_any(spark):
    texts = [
        "2024-03-05 06:07:08",
        "2024-03-05T06:07:08.123456",
        "2024-03-05",
        "20240305",
        "05/03/2024",
        "5 Mar 2024",
        "1709618828",
        "2024-03-05T06:07:08+02:00",
        "garbage",
        "",
        None,
    ]
    day = dt.datetime(2024, 3, 5)
    t = dt.datetime(2024, 3, 5, 6, 7, 8)
    want = [t, t.replace(microsecond=123456), day, day, day, day, t, t - dt.timedelta(hours=2), None, None, None]
    got = col(spark, texts, "string", lambda c: D.parse_any(c).cast("timestamp_ntz"))
    assert got == want


def test_parse_month_first_or_zero(spark):
    got = col(
        spark,
        ["03/05/2024", "2024-03-05", "25/12/2024", "x", None],
        "string",
        lambda c: D.parse_month_first_or_zero(c).cast("timestamp_ntz"),
    )
    zero = dt.datetime(1970, 1, 1)
    assert got == [dt.datetime(2024, 3, 5), dt.datetime(2024, 3, 5), dt.datetime(2024, 12, 25), zero, zero]


def test_readable_size(spark):
    got = col(spark, [0.0, 1023.0, 1024.0, 1536.0, 1048576.0, 5 * 1024.0**4, None], "double", X.readable_size)
    assert got == ["0.00 B", "1023.00 B", "1.00 KiB", "1.50 KiB", "1.00 MiB", "5.00 TiB", None]


def test_html_text(spark):
    pages = [
        " <p> A text <i>with</i><b>tags</b>. <!-- comments <b> --> </p> ",
        "<script>if (a < b) { x('</p>') }</script>shown<style>p > a {}</style>",
        "a<![CDATA[ <kept>  as is ]]>b",
        "one\n\n two\t&amp; three",
        None,
        "",
    ]
    want = ["A text with tags .", "shown", "a <kept>  as is b", "one two &amp; three", None, ""]
    assert col(spark, pages, "string", X.html_text) == want


def test_not_empty(spark):
    assert col(spark, ["a", "", None], "string", X.not_empty) == [True, False, False]


def test_bands(spark):
    got = col(spark, [12.0, 35.4, 55.4, 150.4, 250.4, 250.5], "double", Y.air_quality)
    assert got == ["Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy", "Hazardous"]
    got = col(spark, [999_999, 1_000_000, 10_000_000, 100_000_000], "long", Y.popularity)
    assert got == ["Low (< 1M)", "Medium (1M-10M)", "High (10M-100M)", "Viral (100M+)"]


def test_arithmetic(spark):
    assert col(spark, [7, -7, 0], "long", lambda c: Y.int_div(c, F.lit(2))) == [3, -3, 0]
    assert col(spark, [7], "long", lambda c: Y.int_div(c, F.lit(0))) == [None]
    big = 9_007_199_254_740_993
    assert col(spark, [big], "long", lambda c: Y.int_div(c, F.lit(1))) == [big]
    assert col(spark, [1.0], "double", lambda c: Y.ratio(c, F.lit(0))) == [None]
    assert col(spark, [float("nan"), None, 2.0], "double", lambda c: Y.nan_to(c, 0.0)) == [0.0, 0.0, 2.0]
    assert col(spark, [2.5, 0.125, -1.25], "double", lambda c: Y.round_to(c, 1)) == [2.5, 0.1, -1.3]


def test_enum(spark):
    labels = {"CSH": 1, "CRE": 2}
    assert col(spark, ["CSH", "CRE", "XXX"], "string", lambda c: Y.enum_code(c, labels)) == [1, 2, None]
    assert col(spark, ["CSH", "CRE"], "string", lambda c: Y.enum_is(c, 1, labels)) == [True, False]


def test_ranges(spark):
    days = [dt.datetime(2024, 12, 31, 23, 59, 59), dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 31, 23), dt.datetime(2025, 2, 1)]
    assert col(spark, days, "timestamp_ntz", lambda c: D.in_month(c, 202501)) == [False, True, True, False]
    assert col(spark, days, "timestamp_ntz", lambda c: D.in_year(c, 2024)) == [True, False, False, False]
    assert col(spark, days, "timestamp_ntz", lambda c: D.in_month(c, 202412)) == [True, False, False, False]


def test_row_digest_ignores_column_order_but_not_values(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string").select(H.row_digest("a", "b").alias("h"))
    b = spark.createDataFrame([("x", 1)], "b string, a int").select(H.row_digest("b", "a").alias("h"))
    assert a.first()["h"] == b.first()["h"]
    pairs = [("p|q=1:r", "s"), ("p", "q=1:r|s"), (None, "s"), ("", "s")]
    df = spark.createDataFrame(pairs, "a string, b string").select(H.row_digest("a", "b").alias("h"))
    assert df.distinct().count() == 4


def test_repeatable_values(spark):
    df = spark.range(10_000)
    u = df.select(H.repeatable_unit(1, "id").alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= u[0] < 0.01 and 0.99 < u[1] < 1 and abs(u[2] - 0.5) < 0.02
    counts = [r["count"] for r in df.groupBy(H.shard_of(8, "id").alias("s")).count().collect()]
    assert len(counts) == 8 and max(counts) < 1.2 * min(counts)
