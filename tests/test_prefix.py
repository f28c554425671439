"""Running sums and quantiles against brute force, with hot keys, ties and NULLs."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from brookmill.operators.prefix import exact_quantiles, running_sum


def data(n, seed, hot=True):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if hot and r.random() < 0.5 else r.choice(["a", "b", None])
        order = r.choice([5, 5, 5, r.randrange(50), None])
        rows.append((i, key, order, r.randrange(1, 9)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_running_sum_is_the_same_at_any_size(spark, seed):
    rows = data(400, seed)
    df = spark.createDataFrame(rows, "id int, k string, o int, v int").repartition(4)
    want, totals = {}, defaultdict(int)
    for i, k, o, v in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        totals[k] += v
        want[i] = totals[k]
    for hot_rows in (10**9, 100, 20):
        got = running_sum(df, ["k"], "o", "v", tie=["id"], hot_rows=hot_rows).collect()
        assert {r["id"]: r["running"] for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("hot_rows", [10_000, 15])
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantiles(spark, q, hot_rows):
    import math

    rows = data(300, 7)
    df = spark.createDataFrame(rows, "id int, k string, o int, v int")
    element = {r["k"]: r["x"] for r in exact_quantiles(df, ["k"], "o", {"x": q}, hot_rows=hot_rows).collect()}
    between = {r["k"]: r["x"] for r in exact_quantiles(df, ["k"], "o", {"x": q}, kind="between", hot_rows=hot_rows).collect()}
    groups = defaultdict(list)
    for _, k, o, _ in rows:
        if o is not None:
            groups[k].append(o)
    for k, values in groups.items():
        values.sort()
        n = len(values)
        assert element[k] == values[max(math.ceil(round(q * n, 9)) - 1, 0)]
        at = q * (n - 1)
        low, high = values[math.floor(at)], values[math.ceil(at)]
        assert between[k] == pytest.approx(low + (high - low) * (at - math.floor(at)))


@pytest.mark.parametrize("kind", ["element", "between"])
def test_brackets_leave_most_values_out_and_stay_exact(spark, kind):
    """Large keys next to small ones, continuous and repeated values; brackets against full counting."""
    from brookmill.operators import prefix as P

    df = spark.range(60_000).selectExpr(
        "CASE WHEN id < 40000 THEN 1 WHEN id < 59000 THEN 2 ELSE id END AS k",
        "CASE WHEN id < 40000 THEN pmod(xxhash64(id), 1000003) ELSE id % 7 END AS v",
    )
    qs = {"a": 0.0, "b": 0.001, "c": 0.26, "d": 0.5, "e": 0.9, "f": 1.0}
    near = P._quantiles_by_bracket(df, ["k"], "v", qs, kind, 500, 1000)
    full = P._quantiles_by_count(df, ["k"], "v", qs, kind, 10**9, 1)
    assert near is not None
    assert sorted(map(tuple, near.select("k", *qs).collect())) == sorted(map(tuple, full.select("k", *qs).collect()))


def test_missed_bracket_is_noticed(spark, monkeypatch):
    """A sketch that is wrong must not give a wrong quantile."""
    from brookmill.operators import prefix as P

    df = spark.range(2000).selectExpr("1 AS k", "id AS v")
    wrong = lambda c, *_: P.F.array_repeat(P.F.max(P.F.lit(5).cast("long")), 2)
    monkeypatch.setattr(P.F, "percentile_approx", wrong)
    assert P._quantiles_by_bracket(df, ["k"], "v", {"m": 0.5}, "element", 10_000, 100) is None
    got = P.exact_quantiles(df, ["k"], "v", {"m": 0.5}, hot_rows=500, accuracy=100)
    assert got.first()["m"] == 999


def test_quantiles_without_keys(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4)], "v int")
    assert exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == 2
    assert exact_quantiles(df, [], "v", {"m": 0.5}, kind="between").first()["m"] == 2.5


def test_hot_key_is_spread(spark, monkeypatch):
    """One key and one order value with most rows still fill many parts."""
    from brookmill.operators import prefix

    kept = []
    monkeypatch.setattr(prefix, "cut", lambda df, name: kept.append(df) or df)
    df = spark.range(9000).selectExpr("id", "CASE WHEN id < 8000 THEN 1 ELSE id END AS k", "7 AS o", "1 AS v")
    running_sum(df, ["k"], "o", "v", tie=["id"], hot_rows=1000)
    sizes = [r["count"] for r in kept[0].filter("k = 1").groupBy(prefix._RANGE).count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 2000


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "double"])
def test_split_by_other_order_types(spark, kind):
    made = {
        "date": "date_add(date'2024-01-01', CAST(id % 50 AS INT))",
        "timestamp_ntz": "CAST(timestamp_seconds(id % 50) AS TIMESTAMP_NTZ)",
        "double": "CAST(id % 50 AS DOUBLE) / 3",
    }
    df = spark.range(500).selectExpr("id", "1 AS k", f"{made[kind]} AS o", "1 AS v")
    got = running_sum(df, ["k"], "o", "v", tie=["id"], hot_rows=50).orderBy("running").collect()
    assert [r["running"] for r in got] == list(range(1, 501))
    assert [r["o"] for r in got] == sorted(r["o"] for r in got)
