"""Sort, limit, gap filling and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from brookmill.functions.hashing import stable_sql
from brookmill.functions.dates import epoch_bucket
from brookmill.functions.types import rank_of, round_to
from brookmill.operators.gapfill import fill_gaps
from brookmill.operators.joins import sample_rows
from brookmill.plans.registry import query


@query(
    "sort_keys",
    "SL-01",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC",
)
def sort_keys(t):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy("c_mktsegment", F.desc("c_acctbal"))


@query(
    "sort_top_k",
    "SL-02",
    """
SELECT l_orderkey, l_linenumber, round_to(l_extendedprice * (1 - l_discount), 2) AS revenue
FROM lineitem ORDER BY l_extendedprice * (1 - l_discount) DESC, l_orderkey, l_linenumber LIMIT 25""",
)
def sort_top_k(t):
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        t.lineitem.select("l_orderkey", "l_linenumber", revenue.alias("raw"))
        .orderBy(F.desc("raw"), "l_orderkey", "l_linenumber")
        .limit(25)
        .select("l_orderkey", "l_linenumber", round_to("raw", 2).alias("revenue"))
    )


@query(
    "limit_any",
    "SL-03",
    "SELECT least(10, count(*)) AS n, TRUE AS all_match FROM lineitem WHERE l_returnflag = 'N'",
)
def limit_any(t):
    """Any ten rows that match; which ones is not defined, so their number and whether all match."""
    rows = t.lineitem.filter("l_returnflag = 'N'").select("l_returnflag").limit(10)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("l_returnflag") == "N").alias("all_match"))


@query(
    "limit_random",
    "SL-04",
    f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {stable_sql('3', 'o_orderkey')}, o_orderkey LIMIT 10",
)
def limit_random(t):
    """Ten rows in repeatable random order."""
    return sample_rows(t.orders.select("o_orderkey", "o_totalprice"), 10, salt=3, by=["o_orderkey"])


@query(
    "sort_by_rank",
    "SL-05",
    "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1",
)
def sort_by_rank(t):
    order = ["3-MEDIUM", "1-URGENT", "2-HIGH"]
    return (
        t.orders.groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(rank_of("o_orderpriority", order), "o_orderpriority")
    )


@query(
    "sort_by_abs",
    "SL-06",
    """
SELECT c_custkey, c_acctbal - 4500 AS off FROM customer ORDER BY abs(c_acctbal - 4500) DESC, c_custkey LIMIT 50""",
)
def sort_by_abs(t):
    return (
        t.customer.select("c_custkey", (F.col("c_acctbal") - 4500).alias("off"))
        .orderBy(F.abs("off").desc(), "c_custkey")
        .limit(50)
    )


@query(
    "fill_gaps_overall",
    "SL-07",
    """
WITH chart AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) % 60 AS t, count(*) AS n FROM events GROUP BY 1)
SELECT g.t, coalesce(c.n, 0) AS n
FROM (SELECT unnest(generate_series(min(t), max(t), 60)) AS t FROM chart) g LEFT JOIN chart c ON g.t = c.t""",
)
def fill_gaps_overall(t):
    chart = t.events.groupBy(epoch_bucket("ts", 60).alias("t")).agg(F.count(F.lit(1)).alias("n"))
    return fill_gaps(chart, "t", 60, {"n": 0}).orderBy("t")


@query(
    "fill_gaps_per_series",
    "SL-07",
    """
WITH chart AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) % 3600 AS t, count(*) AS n
               FROM events GROUP BY 1, 2),
grid AS (SELECT unnest(generate_series(min(t), max(t), 3600)) AS t FROM chart)
SELECT u.user_id, g.t, coalesce(c.n, 0) AS n
FROM grid g CROSS JOIN (SELECT DISTINCT user_id FROM chart) u LEFT JOIN chart c ON g.t = c.t AND u.user_id = c.user_id""",
)
def fill_gaps_per_series(t):
    chart = t.events.groupBy("user_id", epoch_bucket("ts", 3600).alias("t")).agg(F.count(F.lit(1)).alias("n"))
    return fill_gaps(chart, "t", 3600, {"n": 0}, per=["user_id"])


@query(
    "limit_offset",
    "SL-08",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 100",
)
def limit_offset(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(100).limit(20)


@query(
    "latest_previews",
    "SL-09",
    """
SELECT doc_id, lang, substring(text, 1, 50) AS preview FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10""",
)
def latest_previews(t):
    return (
        t.documents.orderBy(F.desc("n_chars"), "doc_id")
        .limit(10)
        .select("doc_id", "lang", F.substring("text", 1, 50).alias("preview"))
    )


@query(
    "union_labelled",
    "SO-01",
    """
SELECT 'orders' AS method, count(*) AS records FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events""",
)
def union_labelled(t):
    from brookmill.operators.aggregates import labelled_counts

    return labelled_counts({"orders": t.orders, "lineitem": t.lineitem, "events": t.events})


@query(
    "cte_chained",
    "SO-04 SO-03",
    """
WITH per_customer AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1),
     per_segment AS (SELECT c_mktsegment, n, total FROM per_customer JOIN customer ON o_custkey = c_custkey)
SELECT c_mktsegment, CAST(sum(n) AS BIGINT) AS orders, round_to(sum(total), 2) AS total FROM per_segment GROUP BY 1""",
)
def cte_chained(t):
    per_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    per_segment = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return per_segment.groupBy("c_mktsegment").agg(F.sum("n").alias("orders"), round_to(F.sum("total"), 2).alias("total"))


@query(
    "stored_view",
    "SO-06",
    """
SELECT o_custkey, count(*) AS n, round_to(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1 HAVING count(*) > 5""",
)
def stored_view(t):
    t.orders.createOrReplaceTempView("orders_source")
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY VIEW busy_customers AS
           SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total
           FROM orders_source GROUP BY o_custkey HAVING n > 5"""
    )
    return t.spark.table("busy_customers").withColumn("total", round_to("total", 2))
