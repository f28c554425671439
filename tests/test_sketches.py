"""Error bounds of approximate results."""

from __future__ import annotations

from types import SimpleNamespace

from brookmill.plans import aggregates, load_all, rollups

ALL = load_all()


def test_approx_distinct(middle):
    for r in aggregates.distinct_parts(middle).collect():
        assert abs(r["approx_parts"] - r["parts"]) <= 0.05 * r["parts"]
    for r in aggregates.merged_ids(middle).collect():
        assert abs(r["approx_ids"] - r["ids"]) <= max(1, 0.05 * r["ids"])


def test_approx_distinct_keeps_rows_without_a_flag(spark):
    """The two counts of the group of missing flags meet too."""
    rows = spark.createDataFrame([(None, 1), (None, 2), ("A", 1), ("A", None)], "l_returnflag string, l_partkey long")
    got = aggregates.agg_distinct_approx(SimpleNamespace(lineitem=rows)).collect()
    assert sorted(map(tuple, got), key=str) == [("A", 1, True), (None, 2, True)]


def _rank(values, x):
    return sum(v <= x for v in values) / len(values)


def test_quantile_sketches(middle):
    prices = {}
    for r in middle.lineitem.select("l_returnflag", "l_extendedprice").collect():
        prices.setdefault(r[0], []).append(r[1])
    for sketch in (aggregates.merged_price_quantiles, aggregates.approx_price_quantiles):
        for r in sketch(middle).collect():
            assert abs(_rank(prices[r["l_returnflag"]], r["median_price"]) - 0.5) < 0.02
            assert abs(_rank(prices[r["l_returnflag"]], r["p90_price"]) - 0.9) < 0.02


def test_wide_statistics(middle):
    exact = {r["product_id"]: r for r in ALL["q_stats_base"].build(middle).collect()}
    got = rollups.stats_from_states(middle).collect()
    assert len(got) == len(exact)
    for r in got:
        want = exact[r["product_id"]]
        assert r["n"] == want["sales_count"]
        assert abs(r["unique_ids"] - want["unique_sales"]) <= max(1, 0.05 * want["unique_sales"])
        assert abs(r["avg_value"] - want["avg_sales"]) < 0.01


def test_stored_sketches_hold_their_bounds(middle):
    got = ALL["q_stats_rollup"].build(middle).collect()
    assert got and all(r["ids_close"] and r["median_close"] and r["p90_close"] for r in got)


def test_manual_stats(middle):
    r = ALL["q_manual_stats"].build(middle).first()
    assert r["total_records"] == 10_000 and r["locations_close"] and r["batches_close"]


def test_paths_agree(middle):
    assert ALL["agg_paths_agree"].build(middle).first()["differing_rows"] == 0


def test_shard_reports(middle):
    skew = ALL["shard_skew"].build(middle).collect()
    assert sum(r["records"] for r in skew) == middle.orders.count()
    sizes = ALL["table_sizes"].build(middle).collect()
    assert {r["table"]: r["total_rows"] for r in sizes}["lineitem"] == 60_000
    assert all(r["stored"] for r in sizes)
    days = ALL["menu_spread_days"].build(middle).collect()
    assert len(days) == 564 and sum(r["items"] for r in days) == 60_000
