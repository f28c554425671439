"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores), ``BENCH_ALL=1``
(every named query), ``BENCH_RUNS`` (runs per query, the fastest counts; default 2).
Every query is built and run to the end into a sink that drops the rows, so writes
and streams inside a query are part of its time.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HEADLINE = """
q_payment_count q_transactions_totals q_type_functions q_udf_classify q_udf_fraud udf_classify_batch
q_genres_flat q_no_genre q_anti q_cross q_comma_join q_actors_year_names q_actors_year_prewhere
q_dict_running_sum q_menu_denorm q_sales_base q_stats_base q_stats_rollup
q_s3_avg q_s3_by_user q_s3_modulo q_metric_queries q_heavy q_log_counts q_log_like
q_like_ratio_topk q_monthly_median q_category_stats q_month_counts q_location_totals q_alerts
q_pipeline_summary q_sensor_types q_ds_hourly q_ds_geo q_viz_corr q_viz_coverage q_viz_daily_aqi
q_channels_top q_years q_popularity q_federated_join q_ext_view
agg_distinct_exact agg_median_element agg_quantiles agg_corr_matrix agg_merge_states
merge_latest merge_collapse fill_gaps_per_series fn_html_text pf_year sort_top_k
q_activity_after_update q_activity_after_delete dedup_batch stream_typed_table stream_rollup q_sales_rollup
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))

    from pyspark.sql import functions as F

    from brookmill.functions.dates import in_year
    from brookmill.operators.rollups import Rollup
    from brookmill.operators.tables import write_clustered
    from brookmill.plans import load_all
    from brookmill.scratch import new_path
    from brookmill.session import build_session
    from brookmill.sources.tables import Tables

    spark = build_session(
        f"local[{cpus}]",
        "bench",
        shuffle_partitions=cpus,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load_all()
    names = list(queries) if os.environ.get("BENCH_ALL") == "1" else HEADLINE

    def timed(build) -> float:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        return round(best, 4)

    queries["q_month_counts"].run(spark, folder).collect()
    seconds = {}
    for name in names:
        try:
            seconds[name] = timed(lambda name=name: queries[name].run(spark, folder))
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the others
            print(f"{name}: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            seconds[name] = None

    # Two relative checks: a stored rollup is read faster than the base is
    # aggregated, and a clustered table skips files for a range.
    t = Tables(spark, folder)
    sums = {"quantity": F.col("l_quantity"), "amount": F.col("l_quantity") * F.col("l_extendedprice")}
    rollup = Rollup(spark, new_path(spark, "bench-rollup"), "year", ["l_suppkey"], sums)
    rollup.add_batch(t.lineitem.withColumn("year", F.year("l_shipdate")), "all")
    checks = {
        "base_aggregation": timed(lambda: t.lineitem.groupBy("l_suppkey").agg(*[F.sum(c).alias(n) for n, c in sums.items()])),
        "rollup_read": timed(rollup.read),
    }
    path = new_path(spark, "bench-clustered")
    write_clustered(t.lineitem, path, ["l_shipdate"], files=16)
    stored = spark.read.parquet(path)
    files = lambda df: df.select(F.col("_metadata.file_name")).distinct().count()
    checks["files_whole"] = files(stored)
    checks["files_one_year"] = files(stored.filter(in_year("l_shipdate", 1997)))

    scale = re.search(r"sf([\d.]+)", folder)
    total = round(sum(v for v in seconds.values() if v), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total" if names is HEADLINE else "all_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "checks": checks,
                "sf": float(scale[1]) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
