"""What reaches the scan and which joins are used."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from brookmill.functions.dates import in_month, in_year, since
from brookmill.plans import load_all

ALL = load_all()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_and_month_ranges_are_pushed(small):
    for test in (in_year("l_shipdate", 1995), in_month("l_shipdate", 199512), since("l_shipdate", dt.datetime(2000, 1, 1), days=3)):
        text = plan(small.lineitem.filter(test).select("l_orderkey"))
        assert "GreaterThanOrEqual(l_shipdate" in text
        assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_enum_code_is_pushed(small):
    assert "EqualTo(l_returnflag,N)" in plan(ALL["q_payment_count"].build(small))


def test_partition_filter(small):
    assert "PartitionFilters: [isnotnull(ym" in plan(ALL["sink_partitioned_month"].build(small))


def test_anti_join(small):
    assert "LeftAnti" in plan(ALL["q_anti"].build(small))


def test_product_without_cross_join(small):
    text = plan(ALL["q_cross"].build(small))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "TakeOrderedAndProject" in text


def test_no_cross_join_anywhere(small):
    """Over all cheap-to-plan named queries that read the tables directly."""
    for name in ("agg_corr_matrix", "q_genres_flat", "q_menu_denorm", "fill_gaps_per_series", "q_metric_queries"):
        text = plan(ALL[name].build(small))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_gaps_come_without_a_product_or_a_join(small):
    """Per series, the missing buckets follow from the present ones alone."""
    text = plan(ALL["fill_gaps_per_series"].build(small))
    assert "Join" not in text and "CartesianProduct" not in text


def test_frequent_keys_are_joined_apart(spark, small):
    """With skew handling of the session off, the rows of a frequent key meet their one dictionary row without a shuffle."""
    from brookmill.operators.joins import frequent_keys, lookup

    rows = spark.range(30_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    words = spark.range(20_000).select(F.col("id").alias("k"), F.concat(F.lit("w"), "id").alias("word"))
    assert frequent_keys(rows, F.col("k"), 0.05) == [7] and frequent_keys(words, F.col("k"), 0.05) == []
    assert frequent_keys(rows.limit(0), F.col("k"), 0.05) == []
    kept = {s: spark.conf.get(s) for s in ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = lookup(rows, words, "k", "k", {"word": "none"}, hot=0.05)
        assert plan(found).count("BroadcastHashJoin") == 1 and plan(found).count("SortMergeJoin") == 1
        counted = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).filter("n > 1").collect()}
        assert counted == {"w7": 10_001, "none": 6_667} and found.count() == 30_000
    finally:
        for s, v in kept.items():
            spark.conf.set(s, v)


def test_planned_steps_read_their_range(spark, small):
    from brookmill.scratch import new_path
    from brookmill.streaming import marks

    path = new_path(spark, "load-plan")
    rows = small.orders.select("o_orderkey", "o_orderdate")
    steps = marks.plan_steps(rows, "o_orderdate", path, 300)
    assert steps > 3 and marks.plan_steps(rows, "o_orderdate", path, 1) == steps
    text = plan(marks.planned_rows(rows, "o_orderdate", path, 2))
    assert "GreaterThan(o_orderdate" in text and "LessThanOrEqual(o_orderdate" in text
    sizes = [marks.planned_rows(rows, "o_orderdate", path, i).count() for i in range(steps)]
    assert sum(sizes) == rows.filter("o_orderdate IS NOT NULL").count() and max(sizes) < 450


def test_top_k_is_not_a_full_sort(small):
    assert "TakeOrderedAndProject" in plan(ALL["q_like_ratio_topk"].build(small))


def test_correlations_scan_once(small):
    assert plan(ALL["agg_corr_matrix"].build(small)).count("FileScan") == 1


def test_no_python_in_native_functions(small):
    assert "ArrowEvalPython" not in plan(ALL["q_udf_classify"].build(small))
    assert "ArrowEvalPython" not in plan(ALL["udf_classify_batch"].build(small))


def test_distinct_before_join(small):
    """Repeats are removed map-side before anything is joined."""
    text = plan(ALL["q_genres_flat"].build(small))
    assert text.count("HashAggregate") >= 2


def test_clustered_file_skips_row_groups(spark, small, path):
    from brookmill.operators.tables import write_clustered

    write_clustered(small.lineitem, path, ["l_shipdate"], files=8)
    stored = spark.read.parquet(path)
    files = stored.filter(in_year("l_shipdate", 1995)).select(F.col("_metadata.file_name").alias("f")).distinct().count()
    assert files <= 3


def test_exact_counts_carry_no_approximate_states(small):
    """No aggregate that groups by the counted value holds a sketch."""
    for name, value in (("q_manual_stats", "location_key"), ("q_manual_stats", "batch_id"), ("agg_distinct_approx", "l_partkey")):
        df = ALL[name].build(small)
        groups = [line for line in plan(df).splitlines() if "HashAggregate(keys=[" in line and f"{value}#" in line.split("functions=")[0]]
        assert groups and not any("approx_count_distinct" in line for line in groups)


def test_literal_rows_leave_the_other_side_in_place(small):
    text = plan(ALL["scan_values"].build(small))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_distinct_ids_are_counted_without_the_statistics(small):
    """The aggregates that group by id hold nothing else."""
    for name, key in (("supplier_stats_rollup", "supplier_id"), ("q_stats_rollup", "product_id")):
        lines = [line for line in plan(ALL[name].build(small)).splitlines() if "Aggregate(keys=[" in line]
        wide = [line for line in lines if "id#" in line.split("functions=")[0].replace(f"{key}#", "")]
        assert wide and all(line.split("functions=")[1].startswith("[]") for line in wide)
