"""Rollups, their reads, drift and repair, and the minimum slice."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.functions.types import round_to
from brookmill.operators import rollups as R
from brookmill.operators import tables as W
from brookmill.operators.projections import Projection
from brookmill.operators.prefix import exact_quantiles
from brookmill.operators.sketches import read_stat_states, stat_states
from brookmill.plans.registry import query
from brookmill.plans.views import SALES, sales
from brookmill.scratch import cut, new_path
from brookmill.streaming import ingest

def _amount():
    return F.col("quantity") * F.col("price")


def _sums():
    return {"total_quantity": F.col("quantity"), "total_sales": _amount()}



def _rollup(t, name="sales-rollup") -> R.Rollup:
    return R.Rollup(t.spark, new_path(t.spark, name), "month", ["product_id"], _sums())


def _final(df):
    return df.select(
        "product_id", "total_quantity", round_to("total_sales", 2).alias("total_sales")
    )


def _with_flag(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("month"),
        F.col("l_returnflag").alias("flag"),
    )


_BASE_SQL = f"""
WITH {SALES}
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_quantity, round_to(sum(quantity * price), 2) AS total_sales
FROM sales GROUP BY product_id ORDER BY product_id"""


@query("q_sales_base", "AG-18 AG-24", _BASE_SQL)
def sales_base(t):
    totals = sales(t).groupBy("product_id").agg(*[F.sum(c).alias(n) for n, c in _sums().items()])
    return _final(totals).orderBy("product_id")


def build_rollup(t) -> R.Rollup:
    """Rollup of all sales, arriving in three batches."""
    rollup = _rollup(t)
    for flag in ("A", "N", "R"):
        rollup.add_batch(_batch(t, flag), flag)
    return rollup


def _batch(t, flag):
    """Rows of one flag; those with another one or none come with 'R'."""
    known = F.coalesce(F.col("flag"), F.lit("R"))
    return _with_flag(t).filter(F.when(known.isin("A", "N"), known).otherwise("R") == flag)


def _months(t):
    found = t.lineitem.select((F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("m")).distinct()
    return sorted(r["m"] for r in found.filter("m IS NOT NULL").collect())


def populated_rollup(t) -> R.Rollup:
    """Rollup of all sales, created and filled in one step."""
    rollup = _rollup(t)
    rollup.add_batch(sales(t), "populate")
    return rollup


@query("q_sales_rollup", "MV-01 MV-03 AG-18 AG-24", _BASE_SQL)
def sales_rollup(t):
    return _final(populated_rollup(t).read()).orderBy("product_id")


@query("rollup_replay", "MV-01", _BASE_SQL)
def rollup_replay(t):
    """The last batch comes twice; nothing counts twice."""
    rollup = build_rollup(t)
    rollup.add_batch(_batch(t, "R"), "R")
    return _final(rollup.read())


@query("rollup_backfill", "MV-02", _BASE_SQL)
def rollup_backfill(t):
    """The view starts with 'R' rows; the rows before it are filled in by hand."""
    rollup = _rollup(t)
    rollup.add_batch(_batch(t, "R"), "live")
    rollup.backfill(_with_flag(t), F.col("flag").isin("A", "N"))
    return _final(rollup.read())


@query(
    "rollup_without_backfill",
    "MV-02",
    f"""
WITH {SALES}
SELECT l_partkey AS product_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity,
       round_to(sum(CAST(l_quantity AS BIGINT) * l_extendedprice), 2) AS total_sales
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
)
def rollup_without_backfill(t):
    rollup = _rollup(t)
    rollup.add_batch(_with_flag(t).filter("flag = 'R'"), "live")
    return _final(rollup.read())


@query("rollup_compacted", "MV-01", _BASE_SQL)
def rollup_compacted(t):
    """All months merged into one set of state rows."""
    rollup = build_rollup(t)
    rollup.compact(_months(t))
    return _final(rollup.read())


@query("rollup_compact_replay", "MV-01", _BASE_SQL)
def rollup_compact_replay(t):
    """Two batches are compacted, come again, and only then the third one comes: nothing counts twice or is lost."""
    rollup = _rollup(t)
    for flag in ("A", "N"):
        rollup.add_batch(_batch(t, flag), flag)
    rollup.compact(_months(t))
    for flag in ("A", "N", "R"):
        rollup.add_batch(_batch(t, flag), flag)
    return _final(rollup.read())


@query("rollup_corrected_batch", "MV-01", _BASE_SQL)
def rollup_corrected_batch(t):
    """A batch came with rows of another one and wrong prices; coming again, it replaces itself in all periods."""
    rollup = _rollup(t)
    rollup.add_batch(_with_flag(t).withColumn("price", F.col("price") * 3), "R")
    for flag in ("A", "N", "R"):
        rollup.add_batch(_batch(t, flag), flag)
    return _final(rollup.read())


#: Rows of a topic's file, about; one task writes a file. The stream takes a third of the files at a time.
TOPIC_FILE_ROWS = 1_000_000


@query("rollup_populate_then_stream", "MV-03", _BASE_SQL)
def rollup_populate_then_stream(t):
    """The view is filled with all rows up to an offset and then follows the stream from that offset on."""
    rows = _with_flag(t).withColumn("offset", F.col("id"))
    seen = rows.agg(F.percentile_approx("offset", 0.5).alias("half"), F.count(F.lit(1)).alias("n")).first()
    half, files = seen["half"] or 0, 3 * max(2, math.ceil(seen["n"] / (3 * TOPIC_FILE_ROWS)))
    rollup = _rollup(t)
    rollup.add_batch(rows.filter(F.col("offset") <= half), "populate")
    topic = new_path(t.spark, "sales-topic")
    rows.repartitionByRange(files, "offset").write.parquet(topic)
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files // 3).parquet(topic)
    later = stream.filter(F.col("offset") > half)
    ingest.run_available(later, new_path(t.spark, "cp"), lambda df, batch: rollup.add_batch(df, f"stream-{batch}"))
    return _final(rollup.read())


SALE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("month", T.IntegerType()),
    ]
)


def _changed_base(t):
    """Stored sales and a rollup over them; then all prices of one month double."""
    base = W.Folder(t.spark, new_path(t.spark, "sales"), SALE_SCHEMA, ("month",))
    W.append(base, sales(t))
    rollup = _rollup(t)
    rollup.add_batch(base.read(), "all")
    W.update_where(base, F.col("month") == 199705, {"price": F.col("price") * 2})
    return base, rollup


_DRIFTED = f"""
WITH {SALES}, changed AS (
  SELECT product_id, quantity, month, CASE WHEN month = 199705 THEN price * 2 ELSE price END AS price FROM sales),
b AS (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS q, round_to(sum(quantity * price), 2) AS s FROM changed GROUP BY 1),
v AS (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS q, round_to(sum(quantity * price), 2) AS s FROM sales GROUP BY 1)"""


@query(
    "rollup_drift",
    "MV-06",
    _DRIFTED
    + """
SELECT product_id, b.s AS base_total_sales, v.s AS view_total_sales
FROM b JOIN v USING (product_id) WHERE b.s <> v.s OR b.q <> v.q""",
)
def rollup_drift(t):
    base, rollup = _changed_base(t)
    now = R.merge_sums(R.sum_states(base.read(), ["product_id"], _sums()), ["product_id"], list(_sums()))
    off = R.drift(now, rollup.read(), ["product_id"], list(_sums()))
    return off.select(
        "product_id",
        round_to("base_total_sales", 2).alias("base_total_sales"),
        round_to("view_total_sales", 2).alias("view_total_sales"),
    )


@query(
    "rollup_rebuilt",
    "MV-06",
    _DRIFTED + " SELECT product_id, q AS total_quantity, s AS total_sales FROM b",
)
def rollup_rebuilt(t):
    base, rollup = _changed_base(t)
    rollup.rebuild(base.read(), [199705])
    return _final(rollup.read())


def _projected(t):
    """Stored sales and totals per product kept beside them."""
    base = W.Folder(t.spark, new_path(t.spark, "sales"), SALE_SCHEMA, ("month",))
    W.append(base, sales(t))
    measures = {"total_quantity": ("sum", F.col("quantity")), "total_sales": ("sum", _amount()), "sales_count": ("count", F.lit(1)), "highest": ("max", _amount())}
    kept = Projection(base, new_path(t.spark, "sales-projection"), ["product_id"], measures)
    kept.refresh()
    return base, kept


def _projected_final(df):
    return df.select("product_id", "total_quantity", round_to("total_sales", 2).alias("total_sales"), "sales_count", round_to("highest", 2).alias("highest"))


def _projected_sql(rows: str) -> str:
    return f"""
WITH {SALES}, changed AS ({rows})
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_quantity, round_to(sum(quantity * price), 2) AS total_sales,
       count(*) AS sales_count, round_to(max(quantity * price), 2) AS highest FROM changed GROUP BY 1"""


@query(
    "summary_follows_base",
    "MV-08",
    _DRIFTED + " SELECT product_id, q AS total_quantity, s AS total_sales FROM b",
)
def summary_follows_base(t):
    """The base changes in one month; nobody tells the projection, and its next read agrees."""
    base, kept = _projected(t)
    W.update_where(base, F.col("month") == 199705, {"price": F.col("price") * 2})
    return _final(kept.read())


@query("projection_after_delete", "MV-08", _projected_sql("SELECT * FROM sales WHERE NOT coalesce(month = 199603 OR quantity > 45, FALSE)"))
def projection_after_delete(t):
    """One month goes as a whole and some rows of all others."""
    base, kept = _projected(t)
    W.delete_where(base, (F.col("month") == 199603) | (F.col("quantity") > 45))
    return _projected_final(kept.read())


@query("projection_after_append", "MV-08", _projected_sql("""
  SELECT product_id, quantity, price FROM sales UNION ALL SELECT product_id + 1, quantity, price FROM sales WHERE month = 199704"""))
def projection_after_append(t):
    """Rows come in after the projection was stored; it is refreshed, and a second refresh finds nothing to do."""
    base, kept = _projected(t)
    more = sales(t).filter("month = 199704").withColumn("product_id", F.col("product_id") + 1).withColumn("month", F.lit(199705))
    W.append(base, more)
    kept.refresh()
    if kept.refresh():
        raise RuntimeError("partitions changed without a write")
    return _projected_final(kept.read())


@query(
    "q_stats_base",
    "MV-09 AG-15 MV-05",
    f"""
WITH {SALES}
SELECT product_id, count(*) AS sales_count, round_to(avg(quantity * price), 2) AS avg_sales,
       round_to(min(quantity * price), 2) AS min_sales, round_to(max(quantity * price), 2) AS max_sales,
       count(DISTINCT id) AS unique_sales, round_to(quantile_cont(quantity, 0.5), 4) AS median_quantity,
       round_to(quantile_cont(quantity, 0.9), 4) AS quantile_90_quantity
FROM sales GROUP BY product_id""",
)
def stats_base(t):
    s = sales(t)
    amount = _amount()
    stats = s.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("sales_count"),
        round_to(F.avg(amount), 2).alias("avg_sales"),
        round_to(F.min(amount), 2).alias("min_sales"),
        round_to(F.max(amount), 2).alias("max_sales"),
        F.countDistinct("id").alias("unique_sales"),
    )
    q = exact_quantiles(
        s, ["product_id"], "quantity", {"median_quantity": 0.5, "quantile_90_quantity": 0.9}, kind="between"
    )
    rounded = q.select(
        "product_id", *[round_to(c, 4).alias(c) for c in ("median_quantity", "quantile_90_quantity")]
    )
    return stats.join(rounded, "product_id", "left")


def stats_from_states(t):
    """Wide statistics from stored states per product and month; the distinct count and the quantiles are sketches."""
    s = sales(t)
    states = stat_states(s, ["product_id", "month"], F.col("quantity") * F.col("price"), "id", F.col("quantity"))
    path = new_path(t.spark, "stats-rollup")
    W.write_partitioned(states, path, ["month"])
    stored = t.spark.read.schema(states.schema).parquet(path)
    return read_stat_states(stored, ["product_id"], {"median_quantity": 0.5, "quantile_90_quantity": 0.9})


@query(
    "q_stats_rollup",
    "MV-04 MV-05 MV-03 AG-22 AG-23 AG-25 AG-26",
    f"""
WITH {SALES}
SELECT product_id, count(*) AS n, round_to(avg(quantity * price), 2) AS avg_value, round_to(min(quantity * price), 2) AS min_value,
       round_to(max(quantity * price), 2) AS max_value, TRUE AS ids_close, TRUE AS median_close, TRUE AS p90_close
FROM sales GROUP BY product_id""",
)
def stats_rollup(t):
    """Exact columns of the rollup, and whether its sketches hold their bounds: 3 % of the distinct ids, 0.02 of the rank
    plus one row."""
    return _with_bounds(sales(t), stats_from_states(t), "product_id", {"median_quantity": ("median_close", 0.5), "quantile_90_quantity": ("p90_close", 0.9)})


def _with_bounds(rows, read, key: str, quantiles: dict[str, tuple[str, float]]):
    """Statistics read from states, and whether their sketches hold their bounds over ``rows``.

    Ranks are counted per key where the rows are, distinct ids in an aggregate of their own: in one aggregate every
    (key, id) would carry the statistics and the counts of the ranks.
    """
    read = cut(read, "read-states")
    ranks = rows.select(key, "quantity").join(
        read.select(F.col(key).alias("__k"), *quantiles), F.col(key).eqNullSafe(F.col("__k"))
    )
    upto = [F.count_if(F.col("quantity") <= F.col(c)).alias(f"upto_{c}") for c in quantiles]
    below = [F.count_if(F.col("quantity") < F.col(c)).alias(f"below_{c}") for c in quantiles]
    ranks = ranks.groupBy(F.col(key).alias("__r")).agg(*upto, *below)
    ids = rows.groupBy(F.col(key).alias("__i")).agg(F.countDistinct("id").alias("ids"))
    both = read.join(ranks, F.col(key).eqNullSafe(F.col("__r"))).join(ids, F.col(key).eqNullSafe(F.col("__i")))

    def close(c: str, q: float):
        return (F.col(f"upto_{c}") >= (q - 0.02) * F.col("n") - 1) & (F.col(f"below_{c}") <= (q + 0.02) * F.col("n") + 1)

    return both.select(
        key,
        "n",
        *[round_to(c, 2).alias(c) for c in ("avg_value", "min_value", "max_value")],
        (F.abs(F.col("unique_ids") - F.col("ids")) <= F.greatest(F.lit(1.0), 0.03 * F.col("ids"))).alias("ids_close"),
        *[close(c, q).alias(name) for c, (name, q) in quantiles.items()],
    )


def _by_supplier(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.year("l_shipdate").alias("year"),
        F.col("l_returnflag").alias("flag"),
    )


_SUPPLIER_SALES = """
WITH sold AS (SELECT l_orderkey AS id, l_suppkey AS supplier_id, CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS price FROM lineitem)"""


@query(
    "supplier_rollup",
    "MV-01 MV-03",
    f"""{_SUPPLIER_SALES}
SELECT supplier_id, CAST(sum(quantity) AS BIGINT) AS total_quantity, round_to(sum(quantity * price), 2) AS total_sales FROM sold GROUP BY 1""",
)
def supplier_rollup(t):
    """Totals per supplier from states per supplier and year, about a hundredth of the rows at full size; filled from
    what is there, then fed by a batch."""
    rollup = R.Rollup(t.spark, new_path(t.spark, "supplier-rollup"), "year", ["supplier_id"], _sums())
    later = F.coalesce(F.col("flag") == "R", F.lit(False))
    rollup.add_batch(_by_supplier(t).filter(~later), "populate")
    rollup.add_batch(_by_supplier(t).filter(later), "batch")
    return rollup.read().select("supplier_id", "total_quantity", round_to("total_sales", 2).alias("total_sales"))


@query(
    "supplier_stats_rollup",
    "MV-04 MV-05 AG-22 AG-23 AG-25 AG-26",
    f"""{_SUPPLIER_SALES}, stats AS (
  SELECT supplier_id, count(*) AS n, round_to(avg(quantity * price), 2) AS avg_value, round_to(min(quantity * price), 2) AS min_value,
         round_to(max(quantity * price), 2) AS max_value FROM sold GROUP BY 1)
SELECT *, TRUE AS ids_close, TRUE AS median_close FROM stats""",
)
def supplier_stats_rollup(t):
    """Wide statistics per supplier from stored states per supplier and year; sketches hold their bounds of 3 % and 0.02."""
    rows = _by_supplier(t)
    states = stat_states(rows, ["supplier_id", "year"], _amount(), "id", F.col("quantity"))
    path = new_path(t.spark, "supplier-stats")
    W.write_partitioned(states, path, ["year"])
    stored = t.spark.read.schema(states.schema).parquet(path)
    read = read_stat_states(stored, ["supplier_id"], {"median_quantity": 0.5})
    return _with_bounds(rows, read, "supplier_id", {"median_quantity": ("median_close", 0.5)})


@query(
    "stats_rollup_exact_part",
    "MV-04 AG-19 AG-20 AG-21",
    f"""
WITH {SALES}
SELECT product_id, count(*) AS n, round_to(avg(quantity * price), 2) AS avg_value, round_to(min(quantity * price), 2) AS min_value,
       round_to(max(quantity * price), 2) AS max_value FROM sales GROUP BY product_id""",
)
def stats_rollup_exact_part(t):
    r = stats_from_states(t)
    return r.select("product_id", "n", *[round_to(c, 2).alias(c) for c in ("avg_value", "min_value", "max_value")])


@query(
    "resorted_copy",
    "MV-10 SK-03",
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM lineitem""",
)
def resorted_copy(t):
    """A second copy clustered by part: same rows, row groups that can be skipped."""
    rows = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    path = new_path(t.spark, "by-part")
    W.write_clustered(rows, path, ["l_partkey", "l_shipdate"], files=8)
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "metrics_collector",
    "MV-12 FN-34",
    """
SELECT day, metric_name, count(*) AS n, round_to(sum(metric_value), 2) AS total FROM (
  SELECT strftime(l_shipdate, '%Y-%m') AS day, 'Quantity' AS metric_name, l_quantity AS metric_value FROM lineitem
  UNION ALL SELECT strftime(l_shipdate, '%Y-%m'), 'Discount', l_discount FROM lineitem
  UNION ALL SELECT strftime(l_shipdate, '%Y-%m'), 'Price', l_extendedprice FROM lineitem) m
WHERE metric_value > 0 GROUP BY 1, 2""",
)
def metrics_collector(t):
    from brookmill.operators.aggregates import unpivot_measures

    rows = t.lineitem.withColumn("day", F.date_format("l_shipdate", "yyyy-MM"))
    measures = {"Quantity": F.col("l_quantity"), "Discount": F.col("l_discount"), "Price": F.col("l_extendedprice")}
    long = unpivot_measures(rows, ["day"], measures, "metric_name", "metric_value").filter("metric_value > 0")
    total = round_to(F.sum("metric_value"), 2)
    return long.groupBy("day", "metric_name").agg(F.count(F.lit(1)).alias("n"), total.alias("total"))
