"""Versions and deltas resolved at read time."""

from __future__ import annotations

from pyspark.sql import functions as F

from brookmill.functions.types import round_to

from brookmill.operators import merge as M
from brookmill.operators.sketches import distinct_state, require_state_types
from brookmill.operators.tables import create_as
from brookmill.plans.registry import query
from brookmill.scratch import new_path


@query(
    "merge_latest",
    "ME-01",
    """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) x WHERE rn = 1""",
)
def merge_latest(t):
    rows = t.events.select("user_id", "event_type", "event_id", "ts", "value")
    return M.latest_by_key(rows, ["user_id", "event_type"], "event_id")


@query(
    "merge_equal_seq",
    "ME-01",
    """
SELECT user_id, date_trunc('minute', ts) AS minute, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
)
def merge_equal_seq(t):
    from brookmill.functions.dates import start_of

    return M.equal_seq(t.events.select("user_id", start_of("minute", "ts").alias("minute")), ["user_id"], "minute")


@query(
    "merge_sum",
    "ME-02",
    """
SELECT l_partkey, l_suppkey, sum(l_quantity) AS l_quantity, CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber
FROM lineitem GROUP BY 1, 2""",
)
def merge_sum(t):
    return M.sum_by_key(t.lineitem, ["l_partkey", "l_suppkey"], ["l_quantity", "l_linenumber"])


def merged_users(t):
    """Distinct-user states per type and day of two halves of the events, the second checked on the way in, merged per type."""
    half = lambda i: t.events.filter(F.pmod("event_id", F.lit(2)) == i)
    states = [
        half(i).groupBy("event_type", F.to_date("ts").alias("day")).agg(distinct_state("user_id").alias("user_uniq"))
        for i in (0, 1)
    ]
    stored = create_as(states[0], new_path(t.spark, "states"))
    require_state_types(states[1], stored)
    merged = stored.unionByName(states[1])
    return merged.groupBy("event_type").agg(F.hll_sketch_estimate(F.hll_union_agg("user_uniq")).alias("approx_users"))


@query(
    "merge_states",
    "ME-03 ME-07",
    "SELECT event_type, count(DISTINCT user_id) AS users, TRUE AS close FROM events GROUP BY 1",
)
def merge_states(t):
    """Exact users per type, and whether the merged states come within 3 % of them."""
    exact = t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    close = F.abs(F.col("approx_users") - F.col("users")) <= F.greatest(F.lit(1.0), 0.03 * F.col("users"))
    both = exact.withColumnRenamed("event_type", "kind").join(merged_users(t), F.col("kind").eqNullSafe(F.col("event_type")))
    return both.select("event_type", "users", close.alias("close"))


def _delta_log(t):
    """Orders as a signed log: each comes as +1; 'F' orders are cancelled; 'O' orders
    are cancelled and come again with twice the price."""
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", (F.col("o_orderkey") * 3).alias("seq"))
    came = base.select("*", F.lit(1).alias("sign"), F.lit(1).alias("version"))
    gone = base.filter("o_orderstatus IN ('F', 'O')").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", (F.col("seq") + 1).alias("seq"), F.lit(-1).alias("sign"), F.lit(1).alias("version")
    )
    again = base.filter("o_orderstatus = 'O'").select(
        "o_orderkey",
        "o_orderstatus",
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
        (F.col("seq") + 2).alias("seq"),
        F.lit(1).alias("sign"),
        F.lit(2).alias("version"),
    )
    return gone.unionByName(again).unionByName(came)


_FINAL = """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       CAST(1 AS INTEGER) AS sign{more} FROM orders WHERE o_orderstatus <> 'F'"""


@query("merge_collapse", "ME-04", _FINAL.format(more=""))
def merge_collapse(t):
    log = _delta_log(t).drop("version")
    return M.collapse(log, ["o_orderkey", "o_orderstatus"], "sign", "seq").drop("seq")


@query(
    "merge_collapse_versioned",
    "ME-05",
    _FINAL.format(more=", CAST(CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS INTEGER) AS version"),
)
def merge_collapse_versioned(t):
    log = _delta_log(t).drop("seq")
    return M.collapse_versioned(log, ["o_orderkey", "o_orderstatus"], "version", "sign")


@query(
    "merge_signed_totals",
    "ME-06",
    """
SELECT o_orderstatus, CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE count(*) END AS BIGINT) AS rows,
       round_to(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN sum(o_totalprice) * 2 ELSE sum(o_totalprice) END, 2) AS o_totalprice
FROM orders GROUP BY 1""",
)
def merge_signed_totals(t):
    totals = M.signed_totals(
        _delta_log(t).withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")),
        ["o_orderstatus"],
        ["o_totalprice"],
        "sign",
    )
    return totals.withColumn("o_totalprice", round_to(F.col("o_totalprice").cast("double"), 2))
