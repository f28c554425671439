"""Aggregate queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from brookmill.operators.aggregates import collect_parts, part_sql
from brookmill.functions.dates import yyyymm
from brookmill.functions.types import hundredths, int_div, ratio, round_to
from brookmill.operators.aggregates import coverage
from brookmill.operators.prefix import exact_quantiles
from brookmill.operators.sketches import count_bitmaps, distinct_bitmaps, distinct_state, quantile_state
from brookmill.plans.registry import query
from brookmill.plans.views import SALES, VIDEOS, sales, videos


@query(
    "q_payment_count",
    "PF-03 FN-25",
    "SELECT count(*) AS trips FROM lineitem WHERE l_returnflag = 'N'",
)
def payment_count(t):
    from brookmill.functions.types import enum_is

    codes = {"N": 1, "A": 2, "R": 3}
    return t.lineitem.filter(enum_is("l_returnflag", 1, codes)).agg(F.count(F.lit(1)).alias("trips"))


@query(
    "q_transactions_totals",
    "AG-01 AG-03",
    """
SELECT round_to(sum(l_extendedprice * l_quantity), 2) AS total_revenue,
       round_to(avg(l_extendedprice * l_quantity), 2) AS avg_revenue_per_transaction,
       sum(l_quantity) AS total_quantity_sold, count(DISTINCT l_suppkey) AS unique_buyers
FROM lineitem""",
)
def transactions_totals(t):
    # Whole hundredths times whole quantities; the sum is a decimal, so it cannot overflow.
    cost = (hundredths("l_extendedprice") * F.col("l_quantity").cast("long")).cast("decimal(18,0)")
    total = F.sum(cost).cast("double") / 100
    return t.lineitem.agg(
        round_to(total, 2).alias("total_revenue"),
        round_to(total / F.count(F.lit(1)), 2).alias("avg_revenue_per_transaction"),
        F.sum("l_quantity").alias("total_quantity_sold"),
        F.countDistinct("l_suppkey").alias("unique_buyers"),
    )


@query(
    "agg_global",
    "AG-02",
    """
SELECT count(*) AS n, round_to(sum(o_totalprice), 2) AS total, round_to(avg(o_totalprice), 2) AS mean,
       max(o_totalprice) AS largest, min(o_totalprice) AS smallest FROM orders""",
)
def agg_global(t):
    return t.orders.agg(
        F.count(F.lit(1)).alias("n"),
        round_to(F.sum("o_totalprice"), 2).alias("total"),
        round_to(F.avg("o_totalprice"), 2).alias("mean"),
        F.max("o_totalprice").alias("largest"),
        F.min("o_totalprice").alias("smallest"),
    )


@query(
    "agg_distinct_exact",
    "AG-03",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1",
)
def agg_distinct_exact(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"))


def _close(approx: str, exact: str, share: float):
    return F.abs(F.col(approx) - F.col(exact)) <= F.greatest(F.lit(1.0), share * F.col(exact))


def distinct_parts(t):
    """Approximate next to exact.

    Each is an aggregate of its own: in one, every (flag, part) would carry the state of the approximate count.
    """
    approx = t.lineitem.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("approx_parts"))
    exact = t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(F.countDistinct("l_partkey").alias("parts"))
    return approx.join(exact, F.col("l_returnflag").eqNullSafe(F.col("flag"))).drop("flag")


@query(
    "agg_distinct_approx",
    "AG-04",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, TRUE AS close FROM lineitem GROUP BY 1",
)
def agg_distinct_approx(t):
    """Exact count, and whether the approximate one lies within three standard errors."""
    return distinct_parts(t).select("l_returnflag", "parts", _close("approx_parts", "parts", 0.06).alias("close"))


@query(
    "q_category_stats",
    "AG-05",
    """
SELECT p_brand AS category, count(*) AS products_count, round_to(avg(p_retailprice), 2) AS avg_price,
       min(p_retailprice) AS min_price, max(p_retailprice) AS max_price
FROM part GROUP BY p_brand ORDER BY products_count DESC""",
)
def category_stats(t):
    return (
        t.part.groupBy(F.col("p_brand").alias("category"))
        .agg(
            F.count(F.lit(1)).alias("products_count"),
            round_to(F.avg("p_retailprice"), 2).alias("avg_price"),
            F.min("p_retailprice").alias("min_price"),
            F.max("p_retailprice").alias("max_price"),
        )
        .orderBy(F.desc("products_count"))
    )


@query(
    "q_month_counts",
    "AG-06 FN-10",
    """
SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month, count(*) AS products_count
FROM orders GROUP BY 1 ORDER BY 1""",
)
def month_counts(t):
    return (
        t.orders.groupBy(yyyymm("o_orderdate").alias("month"))
        .agg(F.count(F.lit(1)).alias("products_count"))
        .orderBy("month")
    )


@query(
    "agg_having_alias",
    "AG-10",
    """
SELECT user_id, count(*) AS n, round_to(sum(value), 2) AS total FROM events GROUP BY user_id
HAVING count(*) > 60 AND sum(value) > 3000""",
)
def agg_having_alias(t):
    return (
        t.events.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("raw"))
        .filter((F.col("n") > 60) & (F.col("raw") > 3000))
        .select("user_id", "n", round_to("raw", 2).alias("total"))
    )


@query(
    "agg_collect_orders",
    "AG-11",
    f"""
SELECT o_custkey, part, array_to_string(list_sort(list(o_orderkey)), ',') AS order_keys
FROM (SELECT o_custkey, o_orderkey, {part_sql("o_custkey", "o_orderkey")} AS part FROM orders) GROUP BY o_custkey, part""",
)
def agg_collect_orders(t):
    parts = collect_parts(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey", ["o_orderkey"], out="k")
    return parts.select("o_custkey", "part", F.array_join(F.col("k").cast("array<string>"), ",").alias("order_keys"))


@query(
    "agg_any_value",
    "AG-12",
    "SELECT c_custkey, any_value(c_name) AS name, count(*) AS orders FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1",
)
def agg_any_value(t):
    # The name depends on the key alone: count orders first, join once per customer.
    n = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    names = t.customer.groupBy("c_custkey").agg(F.any_value("c_name").alias("name"))
    return names.join(n, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "name", "orders")


@query(
    "agg_avg_if",
    "AG-13",
    """
SELECT user_id, round_to(coalesce(avg(CASE WHEN event_type = 'purchase' THEN value END), 0), 4) AS avg_purchase,
       round_to(coalesce(avg(CASE WHEN event_type = 'refund' THEN value END), 0), 4) AS avg_refund
FROM events GROUP BY user_id""",
)
def agg_avg_if(t):
    from brookmill.operators.aggregates import avg_if

    return t.events.groupBy("user_id").agg(
        round_to(avg_if("value", F.col("event_type") == "purchase"), 4).alias("avg_purchase"),
        round_to(avg_if("value", F.col("event_type") == "refund"), 4).alias("avg_refund"),
    )


@query(
    "agg_median_element",
    "AG-14",
    "SELECT l_returnflag, l_linestatus, quantile_disc(l_extendedprice, 0.5) AS median_price FROM lineitem GROUP BY 1, 2",
)
def agg_median_element(t):
    return exact_quantiles(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", {"median_price": 0.5})


@query(
    "agg_quantiles",
    "AG-15",
    """
SELECT l_suppkey, round_to(quantile_cont(l_extendedprice, 0.5), 4) AS median_price,
       round_to(quantile_cont(l_extendedprice, 0.9), 4) AS p90_price
FROM lineitem GROUP BY 1""",
)
def agg_quantiles(t):
    q = exact_quantiles(t.lineitem, ["l_suppkey"], "l_extendedprice", {"m": 0.5, "p": 0.9}, kind="between")
    return q.select("l_suppkey", round_to("m", 4).alias("median_price"), round_to("p", 4).alias("p90_price"))


_RANKS_SQL = "SELECT l_returnflag, count(*) AS n, TRUE AS median_close, TRUE AS p90_close FROM lineitem GROUP BY 1"


def _with_ranks(t, quantiles):
    """Rows per flag, and whether each approximate quantile's rank is within 0.02 of the wanted one."""
    found = quantiles.select(F.col("l_returnflag").alias("flag"), "median_price", "p90_price")
    both = t.lineitem.join(found, F.col("l_returnflag").eqNullSafe(F.col("flag")))

    def close(c: str, q: float):
        upto = F.avg((F.col("l_extendedprice") <= F.col(c)).cast("int"))
        below = F.avg((F.col("l_extendedprice") < F.col(c)).cast("int"))
        return (upto >= q - 0.02) & (below <= q + 0.02)

    return both.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), close("median_price", 0.5).alias("median_close"), close("p90_price", 0.9).alias("p90_close")
    )


def approx_price_quantiles(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.percentile_approx("l_extendedprice", [0.5, 0.9], 10_000).alias("q")
    ).select("l_returnflag", F.col("q")[0].alias("median_price"), F.col("q")[1].alias("p90_price"))


@query("agg_quantiles_approx", "AG-15", _RANKS_SQL)
def agg_quantiles_approx(t):
    return _with_ranks(t, approx_price_quantiles(t))


@query(
    "agg_corr_pair",
    "AG-16",
    "SELECT l_returnflag, round_to(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem GROUP BY 1",
)
def agg_corr_pair(t):
    return t.lineitem.groupBy("l_returnflag").agg(round_to(F.corr("l_quantity", "l_extendedprice"), 6).alias("correlation"))


_LINE_PAIRS = [
    ("Quantity", "Price", "l_quantity", "l_extendedprice"),
    ("Quantity", "Discount", "l_quantity", "l_discount"),
    ("Quantity", "Tax", "l_quantity", "l_tax"),
    ("Price", "Discount", "l_extendedprice", "l_discount"),
    ("Price", "Tax", "l_extendedprice", "l_tax"),
    ("Discount", "Tax", "l_discount", "l_tax"),
]


@query(
    "agg_corr_matrix",
    "AG-17",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS param_x, '{b}' AS param_y, round_to(corr({x}, {y}), 6) AS correlation FROM lineitem"
        for a, b, x, y in _LINE_PAIRS
    ),
)
def agg_corr_matrix(t):
    from brookmill.operators.aggregates import correlations

    return correlations(
        t.lineitem, {"Quantity": "l_quantity", "Price": "l_extendedprice", "Discount": "l_discount", "Tax": "l_tax"}, 6
    )


@query(
    "agg_partial_states",
    "AG-18 AG-19 AG-20 AG-21",
    f"""
WITH {SALES}
SELECT product_id, month, CAST(sum(quantity) AS BIGINT) AS quantity_sum, count(quantity) AS quantity_count,
       min(price) AS price_min, max(price) AS price_max FROM sales GROUP BY 1, 2""",
)
def agg_partial_states(t):
    return sales(t).groupBy("product_id", "month").agg(
        F.sum("quantity").alias("quantity_sum"),
        F.count("quantity").alias("quantity_count"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
    )


@query(
    "agg_merge_states",
    "AG-24",
    f"""
WITH {SALES}
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS quantity, count(quantity) AS n, round_to(avg(quantity), 6) AS avg_quantity,
       min(price) AS min_price, max(price) AS max_price FROM sales GROUP BY 1""",
)
def agg_merge_states(t):
    states = agg_partial_states(t)
    return states.groupBy("product_id").agg(
        F.sum("quantity_sum").alias("quantity"),
        F.sum("quantity_count").alias("n"),
        round_to(ratio(F.sum("quantity_sum"), F.sum("quantity_count")), 6).alias("avg_quantity"),
        F.min("price_min").alias("min_price"),
        F.max("price_max").alias("max_price"),
    )


def merged_ids(t):
    """Distinct-count sketches per month merged per product, next to the exact count."""
    s = sales(t)
    states = s.groupBy("product_id", "month").agg(distinct_state("id").alias("id_uniq"))
    merged = states.groupBy("product_id").agg(F.hll_sketch_estimate(F.hll_union_agg("id_uniq")).alias("approx_ids"))
    exact = s.groupBy("product_id").agg(F.countDistinct("id").alias("ids"))
    return merged.join(exact, "product_id")


@query(
    "agg_uniq_states",
    "AG-22 AG-25",
    f"WITH {SALES} SELECT product_id, count(DISTINCT id) AS ids, TRUE AS close FROM sales GROUP BY 1",
)
def agg_uniq_states(t):
    """Exact count per product, and whether the merged sketches come within 3 % of it."""
    return merged_ids(t).select("product_id", "ids", _close("approx_ids", "ids", 0.03).alias("close"))


@query(
    "agg_uniq_bitmaps",
    "AG-22 AG-25",
    f"WITH {SALES} SELECT month // 100 AS year, count(DISTINCT product_id) AS products FROM sales WHERE month IS NOT NULL GROUP BY 1",
)
def agg_uniq_bitmaps(t):
    """Exact distinct counts per year from bitmaps per month: merging them takes no second look at the rows."""
    states = distinct_bitmaps(sales(t).filter("month IS NOT NULL"), ["month"], "product_id")
    by_year = states.withColumn("year", F.expr("month DIV 100").cast("int"))
    return count_bitmaps(by_year, ["year"], "products")


@query("agg_uniq_sketch_values", "AG-04 AG-22 AG-25")
def agg_uniq_sketch_values(t):
    """The approximate counts themselves, from one pass and from merged sketches, next to the exact ones."""
    once = distinct_parts(t).select("l_returnflag", "approx_parts", "parts")
    months = t.lineitem.withColumn("month", yyyymm("l_shipdate")).groupBy("l_returnflag", "month").agg(distinct_state("l_partkey").alias("part_uniq"))
    merged = months.groupBy("l_returnflag").agg(F.hll_sketch_estimate(F.hll_union_agg("part_uniq")).alias("merged_parts"))
    return once.join(merged, "l_returnflag")


def merged_price_quantiles(t):
    """Quantile sketches per month merged per flag."""
    states = (
        t.lineitem.withColumn("month", yyyymm("l_shipdate"))
        .groupBy("l_returnflag", "month")
        .agg(quantile_state(F.col("l_extendedprice")).alias("price_kll"))
    )
    merged = states.groupBy("l_returnflag").agg(F.kll_merge_agg_double("price_kll").alias("k"))
    return merged.select(
        "l_returnflag",
        *[
            F.kll_sketch_get_quantile_double("k", F.lit(q)).alias(n)
            for n, q in {"median_price": 0.5, "p90_price": 0.9}.items()
        ],
    )


@query("agg_quantile_states", "AG-23 AG-26", _RANKS_SQL)
def agg_quantile_states(t):
    return _with_ranks(t, merged_price_quantiles(t))


@query(
    "agg_ratio_of_sums",
    "AG-27",
    """
SELECT l_returnflag, round_to(sum(l_extendedprice) / nullif(sum(l_quantity), 0), 4) AS price_per_unit,
       round_to(sum(l_extendedprice) / nullif(sum(0 * l_quantity), 0), 4) AS no_divisor
FROM lineitem GROUP BY 1""",
)
def agg_ratio_of_sums(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        round_to(ratio(F.sum("l_extendedprice"), F.sum("l_quantity")), 4).alias("price_per_unit"),
        round_to(ratio(F.sum("l_extendedprice"), F.sum(F.lit(0.0) * F.col("l_quantity"))), 4).alias("no_divisor"),
    )


@query(
    "agg_avg_of_ratios",
    "AG-28",
    """
SELECT l_returnflag, round_to(avg(l_extendedprice / nullif(l_quantity, 0)), 4) AS avg_price_per_unit
FROM lineitem GROUP BY 1""",
)
def agg_avg_of_ratios(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        round_to(F.avg(ratio("l_extendedprice", "l_quantity")), 4).alias("avg_price_per_unit")
    )


@query(
    "agg_coverage",
    "AG-29 PF-09",
    """
SELECT lang, count(*) AS n, round_to(avg(CASE WHEN quality IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS label_coverage,
       CAST(sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unlabelled
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
)
def agg_coverage(t):
    docs = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        round_to(coverage("quality"), 6).alias("label_coverage"),
        F.count_if(F.col("quality").isNull()).alias("unlabelled"),
    )


@query(
    "agg_value_modulo",
    "AG-34 FN-21",
    """
SELECT CAST(CAST(l_quantity AS BIGINT) % 10 AS BIGINT) AS bucket, CAST(floor(l_quantity / 10) AS BIGINT) AS tens,
       count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def agg_value_modulo(t):
    q = F.col("l_quantity").cast("long")
    return t.lineitem.groupBy((q % 10).alias("bucket"), int_div(q, F.lit(10)).alias("tens")).agg(F.count(F.lit(1)).alias("n"))


@query("agg_paths_agree", "AG-35", "SELECT CAST(0 AS BIGINT) AS differing_rows")
def agg_paths_agree(t):
    """Base aggregate, merged rollup and a stored copy must agree: rows that differ (none expected)."""
    from brookmill.operators.checks import differing_rows
    from brookmill.scratch import cut

    s = sales(t)
    base = s.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    rolled = s.groupBy("product_id", "month").agg(F.sum("quantity").alias("q")).groupBy("product_id").agg(F.sum("q").alias("quantity"))
    copy = cut(s, "sales-copy").groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    a = differing_rows(base, rolled).withColumn("pair", F.lit("base-rollup"))
    b = differing_rows(base, copy).withColumn("pair", F.lit("base-copy"))
    both = a.unionByName(b)
    return both.agg(F.count(F.lit(1)).alias("differing_rows"))


@query("q_s3_avg", "SC-17", "SELECT round_to(avg(l_extendedprice), 4) AS avg_value FROM lineitem")
def s3_avg(t):
    return t.lineitem.agg(round_to(F.avg("l_extendedprice"), 4).alias("avg_value"))


@query(
    "q_s3_by_user",
    "SC-17",
    """
SELECT concat('user_', l_suppkey) AS user_name, count(*) AS n, round_to(avg(l_extendedprice), 4) AS avg_value
FROM lineitem GROUP BY 1 ORDER BY n DESC, user_name LIMIT 10""",
)
def s3_by_user(t):
    return (
        t.lineitem.groupBy("l_suppkey")
        .agg(F.count(F.lit(1)).alias("n"), round_to(F.avg("l_extendedprice"), 4).alias("avg_value"))
        .select(F.concat(F.lit("user_"), F.col("l_suppkey").cast("string")).alias("user_name"), "n", "avg_value")
        .orderBy(F.desc("n"), "user_name")
        .limit(10)
    )


@query(
    "q_s3_modulo",
    "SC-17 AG-34",
    """
SELECT CAST(floor(l_extendedprice) AS BIGINT) % 100 AS bucket, count(*) AS n
FROM lineitem GROUP BY 1 ORDER BY 1 LIMIT 10""",
)
def s3_modulo(t):
    return (
        t.lineitem.groupBy((F.floor("l_extendedprice").cast("long") % 100).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("bucket")
        .limit(10)
    )


@query(
    "agg_many_keys_latest",
    "AG-32",
    """
SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS n, max(o_orderdate) AS latest
FROM orders GROUP BY 1, 2, 3""",
)
def agg_many_keys_latest(t):
    return t.orders.groupBy("o_custkey", "o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("latest")
    )


@query(
    "agg_year_totals",
    "AG-09",
    f"""
WITH {VIDEOS}
SELECT CAST(year(upload_date) AS INTEGER) AS y, count(*) AS n, CAST(sum(view_count) AS BIGINT) AS views
FROM videos WHERE upload_date >= DATE '1996-01-01' GROUP BY 1""",
)
def agg_year_totals(t):
    v = videos(t).filter(F.col("upload_date") >= F.lit(dt.date(1996, 1, 1)))
    return v.groupBy(F.year("upload_date").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.sum("view_count").alias("views"))
