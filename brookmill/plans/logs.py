"""Metric charts, log reports and the stream summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from brookmill.functions.types import round_to

from brookmill.functions.dates import epoch_bucket, since, start_of
from brookmill.functions.text import readable_size
from brookmill.operators.aggregates import avg_if, labelled_counts
from brookmill.operators.batches import batch_stats
from brookmill.operators.gapfill import fill_gaps
from brookmill.operators.reports import heaviest
from brookmill.plans.registry import query
from brookmill.plans.views import AS_OF, AS_OF_SQL, CASES, LOGS, METRICS, cases, logs, metrics
from brookmill.sources.tables import union_matching
from brookmill.streaming.alerts import threshold_alerts


def _filled_sql(inner: str, step: int, value: str, host: bool = True) -> str:
    """SQL twin of a chart with gaps filled."""
    filler = "'' AS host, " if host else ""
    return f"""
, chart AS ({inner}),
grid AS (SELECT unnest(generate_series(min(t), max(t), {step})) AS t FROM chart)
SELECT * FROM chart
UNION ALL
SELECT g.t, {filler}0.0 AS {value} FROM grid g WHERE g.t NOT IN (SELECT t FROM chart)"""


def _bucket_sql(ts: str, step: int) -> str:
    return f"CAST(epoch(date_trunc('minute', {ts})) AS BIGINT) - CAST(epoch(date_trunc('minute', {ts})) AS BIGINT) % {step}"


def _metric_chart(t, name: str, step: int, days: int):
    rows = metrics(t).filter(since("collected_at", AS_OF, days=days) & (F.col("metric_name") == name))
    chart = rows.groupBy(epoch_bucket(start_of("minute", "collected_at"), step).alias("t"), "host").agg(
        round_to(avg_if("metric_value", F.col("metric_name") == name), 4).alias("avg_value")
    )
    return fill_gaps(chart, "t", step, {"host": "", "avg_value": 0.0}).orderBy("t", "host")


def _metric_sql(name: str, step: int, days: int) -> str:
    inner = f"""
  SELECT {_bucket_sql("collected_at", step)} AS t, host,
         round_to(coalesce(avg(CASE WHEN metric_name = '{name}' THEN metric_value END), 0), 4) AS avg_value
  FROM metrics WHERE collected_at >= {AS_OF_SQL} - INTERVAL {days} DAY AND metric_name = '{name}'
  GROUP BY 1, 2"""
    return f"WITH {METRICS}" + _filled_sql(inner, step, "avg_value")


@query("q_metric_queries", "AG-13 SL-07 FN-12 FN-23", _metric_sql("view", 600, 30))
def metric_queries(t):
    return _metric_chart(t, "view", 600, 30)


@query("q_metric_merges", "AG-13 SL-07", _metric_sql("error", 300, 14))
def metric_merges(t):
    return _metric_chart(t, "error", 300, 14)


_PK_INNER = f"""
  SELECT CAST(floor(epoch(event_time)) AS BIGINT) - CAST(floor(epoch(event_time)) AS BIGINT) % 3600 AS t, round_to(avg(value), 4) AS avg_value
  FROM (SELECT ts AS event_time, event_type AS metric, value FROM events
        UNION ALL SELECT o_orderdate, o_orderpriority, o_totalprice FROM orders) u
  WHERE event_time >= {AS_OF_SQL} - INTERVAL 30 DAY AND metric = 'purchase' GROUP BY 1"""


@query(
    "q_metric_pk_memory",
    "SC-12 SL-07",
    "WITH one AS (SELECT 1)" + _filled_sql(_PK_INNER, 3600, "avg_value", host=False),
)
def metric_pk_memory(t):
    shape = {
        "metric_log_events": t.events.select(
            F.col("ts").alias("event_time"), F.col("event_type").alias("metric"), "value"
        ),
        "metric_log_orders": t.orders.select(
            F.col("o_orderdate").alias("event_time"),
            F.col("o_orderpriority").alias("metric"),
            F.col("o_totalprice").alias("value"),
        ),
        "other_lineitem": t.lineitem.select(
            F.col("l_shipdate").alias("event_time"),
            F.col("l_returnflag").alias("metric"),
            F.col("l_extendedprice").alias("value"),
        ),
    }
    rows = union_matching(shape, "^metric_log").filter(
        since("event_time", AS_OF, days=30) & (F.col("metric") == "purchase")
    )
    chart = rows.groupBy(epoch_bucket("event_time", 3600).alias("t")).agg(round_to(F.avg("value"), 4).alias("avg_value"))
    return fill_gaps(chart, "t", 3600, {"avg_value": 0.0}).orderBy("t")


_GB_INNER = f"""
  SELECT {_bucket_sql("collected_at", 900)} AS t, host,
         round_to(avg(metric_value * 1000000000) / 1024 / 1024 / 1024, 4) AS avg_memory_gb
  FROM metrics WHERE collected_at >= {AS_OF_SQL} - INTERVAL 30 DAY AND metric_name = 'click'
  GROUP BY 1, 2"""


@query("q_metric_memory_gb", "SL-07 FN-22", f"WITH {METRICS}" + _filled_sql(_GB_INNER, 900, "avg_memory_gb"))
def metric_memory_gb(t):
    rows = metrics(t).filter(since("collected_at", AS_OF, days=30) & (F.col("metric_name") == "click"))
    chart = rows.groupBy(epoch_bucket(start_of("minute", "collected_at"), 900).alias("t"), "host").agg(
        round_to(F.avg(F.col("metric_value") * 1000000000) / 1024 / 1024 / 1024, 4).alias("avg_memory_gb")
    )
    return fill_gaps(chart, "t", 900, {"host": "", "avg_memory_gb": 0.0}).orderBy("t", "host")


_SIZE_SQL = """CASE
 WHEN abs({b}) < 1024 THEN printf('%.2f B', round_to({b}, 2))
 WHEN abs({b}) < 1048576 THEN printf('%.2f KiB', round_to({b} / 1024, 2))
 WHEN abs({b}) < 1073741824 THEN printf('%.2f MiB', round_to({b} / 1048576, 2))
 WHEN abs({b}) < 1099511627776 THEN printf('%.2f GiB', round_to({b} / 1073741824, 2))
 ELSE printf('%.2f TiB', round_to({b} / 1099511627776, 2)) END"""


@query(
    "q_heavy",
    "IN-07 FN-30 SL-02 PF-11",
    f"""
SELECT event_id AS query_id, user_id AS user, {_SIZE_SQL.format(b="(value * 1048576)")} AS memory,
       CAST(floor(value) AS BIGINT) AS query_duration_ms, substring(props, 1, 100) AS query_preview
FROM events WHERE ts >= {AS_OF_SQL} - INTERVAL 30 DAY AND event_type = 'view'
ORDER BY value DESC, event_id LIMIT 5""",
)
def heavy(t):
    rows = t.events.filter(since("ts", AS_OF, days=30) & (F.col("event_type") == "view")).withColumn(
        "memory_usage", F.col("value") * 1048576
    )
    return heaviest(rows, "memory_usage", 5, ["event_id"], text="props").select(
        F.col("event_id").alias("query_id"),
        F.col("user_id").alias("user"),
        "memory",
        F.floor("value").cast("long").alias("query_duration_ms"),
        F.col("preview").alias("query_preview"),
    )


@query(
    "q_memory_metrics",
    "IN-07 PF-05 FN-30",
    f"""
SELECT {_SIZE_SQL.format(b="(o_totalprice * 1024)")} AS memory_usage, o_orderpriority || ' ' || o_orderkey AS metric
FROM orders WHERE o_orderpriority LIKE '%MEDIUM%'""",
)
def memory_metrics(t):
    return (
        t.orders.filter(F.col("o_orderpriority").like("%MEDIUM%"))
        .orderBy(F.desc("o_totalprice"))
        .select(
            readable_size(F.col("o_totalprice") * 1024).alias("memory_usage"),
            F.concat("o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string")).alias("metric"),
        )
    )


@query(
    "q_log_counts",
    "IN-03 AG-32",
    f"""
WITH {LOGS}
SELECT replica_name, replica_shard, replica_num, count(*) AS log_count, max(timestamp) AS last_ingestion
FROM logs GROUP BY ALL ORDER BY replica_shard, replica_num""",
)
def log_counts(t):
    return (
        logs(t)
        .groupBy("replica_name", "replica_shard", "replica_num")
        .agg(F.count(F.lit(1)).alias("log_count"), F.max("timestamp").alias("last_ingestion"))
        .orderBy("replica_shard", "replica_num")
    )


@query(
    "q_log_levels",
    "AG-05",
    f"""
WITH {LOGS}
SELECT level, replica_shard, count(*) AS log_count FROM logs GROUP BY ALL ORDER BY replica_shard, level""",
)
def log_levels(t):
    return (
        logs(t)
        .groupBy("level", "replica_shard")
        .agg(F.count(F.lit(1)).alias("log_count"))
        .orderBy("replica_shard", "level")
    )


@query(
    "q_log_preview",
    "SL-09 FN-02",
    f"""
WITH {LOGS}
SELECT message[1:50] AS head, level AS severity, logger_name AS logger, timestamp AS logged_at,
       replica_name AS host, replica_shard AS shard, replica_num AS copy
FROM logs ORDER BY logged_at DESC, message LIMIT 10""",
)
def log_preview(t):
    return (
        logs(t)
        .orderBy(F.desc("timestamp"), "message")
        .limit(10)
        .select(
            F.substring("message", 1, 50).alias("head"),
            F.col("level").alias("severity"),
            F.col("logger_name").alias("logger"),
            F.col("timestamp").alias("logged_at"),
            F.col("replica_name").alias("host"),
            F.col("replica_shard").alias("shard"),
            F.col("replica_num").alias("copy"),
        )
    )


@query(
    "q_log_span",
    "AG-30",
    f"""
WITH {LOGS}
SELECT replica_name, count(*) AS logs_count, min(timestamp) AS first_log, max(timestamp) AS last_log
FROM logs GROUP BY replica_name ORDER BY replica_name""",
)
def log_span(t):
    return (
        logs(t)
        .groupBy("replica_name")
        .agg(F.count(F.lit(1)).alias("logs_count"), F.min("timestamp").alias("first_log"), F.max("timestamp").alias("last_log"))
        .orderBy("replica_name")
    )


@query(
    "q_log_like",
    "PF-05",
    f"""
WITH {LOGS}
SELECT replica_name, replica_shard, replica_num, count(*) AS logs_count
FROM logs WHERE message LIKE '%from user 1%' GROUP BY ALL ORDER BY replica_shard, replica_num""",
)
def log_like(t):
    return (
        logs(t)
        .filter(F.col("message").like("%from user 1%"))
        .groupBy("replica_name", "replica_shard", "replica_num")
        .agg(F.count(F.lit(1)).alias("logs_count"))
        .orderBy("replica_shard", "replica_num")
    )


@query(
    "q_log_replicas",
    "PF-15",
    f"""
WITH {LOGS}
SELECT DISTINCT replica_name, replica_shard, replica_num FROM logs ORDER BY replica_shard, replica_num""",
)
def log_replicas(t):
    return logs(t).select("replica_name", "replica_shard", "replica_num").distinct().orderBy("replica_shard", "replica_num")


@query(
    "q_location_totals",
    "AG-33",
    f"""
WITH {CASES}
SELECT location_key, count(*) AS records_count, CAST(sum(new_confirmed) AS BIGINT) AS total_new_confirmed,
       max(new_confirmed) AS max_daily_confirmed, strftime(max(date), '%Y-%m-%d') AS latest_date
FROM cases GROUP BY location_key ORDER BY total_new_confirmed DESC, location_key LIMIT 10""",
)
def location_totals(t):
    return (
        cases(t)
        .groupBy("location_key")
        .agg(
            F.count(F.lit(1)).alias("records_count"),
            F.sum("new_confirmed").alias("total_new_confirmed"),
            F.max("new_confirmed").alias("max_daily_confirmed"),
            F.date_format(F.max("date"), "yyyy-MM-dd").alias("latest_date"),
        )
        .orderBy(F.desc("total_new_confirmed"), "location_key")
        .limit(10)
    )


ALERT_NOW = dt.datetime(2024, 1, 30, 12)
ALERTS_SQL = f"""
SELECT TIMESTAMP '2024-01-30 12:00:00' AS alert_time, location_key, 'HIGH_CASES' AS alert_type,
       CAST(100 AS INTEGER) AS threshold_value, CAST(sum(new_confirmed) AS BIGINT) AS actual_value,
       'High daily cases in ' || location_key || ': ' || CAST(sum(new_confirmed) AS VARCHAR) AS message
FROM cases WHERE date >= DATE '2024-01-29' GROUP BY location_key HAVING sum(new_confirmed) > 100"""


@query("q_alerts", "ST-10 FN-04 FN-14", f"WITH {CASES} {ALERTS_SQL}")
def alerts(t):
    return threshold_alerts(cases(t), "location_key", "date", "new_confirmed", 100, ALERT_NOW)


@query(
    "q_method_compare",
    "SO-01",
    """
SELECT 'Stream' AS method, count(*) AS records FROM events
UNION ALL SELECT 'Manual' AS method, count(*) AS records FROM orders ORDER BY method""",
)
def method_compare(t):
    return labelled_counts({"Stream": t.events, "Manual": t.orders}).orderBy("method")


@query(
    "q_batch_stats",
    "AG-30",
    """
SELECT strftime(ts, '%Y%m%d') AS batch_id, count(*) AS records_in_batch, min(ts) AS batch_start, max(ts) AS batch_end,
       CAST(epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) AS BIGINT) AS batch_duration_seconds
FROM events GROUP BY 1 ORDER BY batch_start DESC LIMIT 10""",
)
def batch_statistics(t):
    rows = t.events.withColumn("batch_id", F.date_format("ts", "yyyyMMdd"))
    return batch_stats(rows, "batch_id", "ts").orderBy(F.desc("batch_start")).limit(10)


@query(
    "q_pipeline_summary",
    "SO-02 SO-03",
    """
SELECT 'Topics' AS component, count(DISTINCT topic) AS count, 'Created by job' AS method
FROM (SELECT event_type AS topic FROM events UNION ALL SELECT o_orderpriority FROM orders) a
UNION ALL
SELECT 'Senders', count(DISTINCT user_id), 'Seen in stream' FROM events
UNION ALL
SELECT 'Data Records', CAST(sum(records) AS BIGINT), 'Streaming'
FROM (SELECT count(*) AS records FROM events UNION ALL SELECT count(*) FROM orders
      UNION ALL SELECT count(*) FROM lineitem) b""",
)
def pipeline_summary(t):
    topics = (
        t.events.select(F.col("event_type").alias("topic"))
        .unionByName(t.orders.select(F.col("o_orderpriority").alias("topic")))
        .agg(F.countDistinct("topic").alias("count"))
        .select(F.lit("Topics").alias("component"), "count", F.lit("Created by job").alias("method"))
    )
    senders = t.events.agg(F.countDistinct("user_id").alias("count")).select(
        F.lit("Senders").alias("component"), "count", F.lit("Seen in stream").alias("method")
    )
    records = (
        labelled_counts({"events": t.events, "orders": t.orders, "lineitem": t.lineitem})
        .agg(F.sum("records").alias("count"))
        .select(F.lit("Data Records").alias("component"), "count", F.lit("Streaming").alias("method"))
    )
    return topics.unionByName(senders).unionByName(records)


@query(
    "q_manual_stats",
    "AG-04",
    f"""
WITH {CASES}
SELECT count(*) AS total_records, TRUE AS locations_close, strftime(min(date), '%Y-%m-%d') AS earliest_date,
       strftime(max(date), '%Y-%m-%d') AS latest_date, TRUE AS batches_close, max(ts) AS last_insertion
FROM cases""",
)
def manual_stats(t):
    """Totals, and whether the approximate distinct counts lie within four standard errors of the exact ones.

    The exact counts are aggregates of their own: beside them every distinct value would carry the approximate states.
    """
    rows = cases(t).withColumn("batch_id", F.date_format("ts", "yyyyMMdd_HH"))
    counted = {"location_key": "locations_close", "batch_id": "batches_close"}
    totals = rows.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.date_format(F.min("date"), "yyyy-MM-dd").alias("earliest_date"),
        F.date_format(F.max("date"), "yyyy-MM-dd").alias("latest_date"),
        F.max("ts").alias("last_insertion"),
        *[F.approx_count_distinct(c, 0.01).alias(f"approx_{c}") for c in counted],
    )
    for c in counted:
        totals = totals.crossJoin(rows.agg(F.countDistinct(c).alias(f"exact_{c}")))

    def close(c: str):
        exact = F.col(f"exact_{c}")
        return (F.abs(F.col(f"approx_{c}") - exact) <= F.greatest(F.lit(1.0), 0.04 * exact)).alias(counted[c])

    return totals.select("total_records", close("location_key"), "earliest_date", "latest_date", close("batch_id"), "last_insertion")
