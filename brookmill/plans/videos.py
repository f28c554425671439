"""Channel and popularity reports, over local and external tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from brookmill.functions.dates import in_year
from brookmill.functions.types import POPULARITY_ABOVE, POPULARITY_BANDS, band_sql, popularity, rank_of, ratio, round_to
from brookmill.operators.filters import limit_then_filter
from brookmill.operators.prefix import exact_quantiles
from brookmill.operators.tables import create_as
from brookmill.plans.registry import query
from brookmill.plans.views import VIDEOS, videos
from brookmill.scratch import new_path
from brookmill.sources.external import Store, append_external, read_external


_STORES: dict[tuple[str, str], Store] = {}


def _external(t) -> Store:
    """An external store that holds the shared tables; filled once per session and folder."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _STORES:
        path = new_path(t.spark, "external-store")
        categories = t.customer.select(
            F.col("c_custkey").alias("uploader_id"),
            F.col("c_mktsegment").alias("main_category"),
            F.col("c_nationkey").alias("country"),
        )
        append_external(videos(t), path, "videos")
        append_external(categories, path, "categories")
        _STORES[key] = Store(t.spark, path, taskBytes=8 << 20)
    return _STORES[key]


#: Fixed value: the view count of the filtered report.
MANY_VIEWS = 50_000_000
_SHORT = ["view_count AS views", "title AS name", "uploader AS channel", "like_count AS likes", "dislike_count AS dislikes"]
_CATEGORIES = "categories AS (SELECT c_custkey AS uploader_id, c_mktsegment AS main_category, c_nationkey AS country FROM customer)"


@query(
    "q_channels_top",
    "AG-27 SL-02",
    f"""
WITH {VIDEOS}
SELECT uploader, CAST(sum(view_count) AS BIGINT) AS total_views, CAST(sum(like_count) AS BIGINT) AS total_likes,
       CAST(sum(dislike_count) AS BIGINT) AS total_dislikes,
       round_to(CAST(sum(like_count) AS DOUBLE) / nullif(sum(dislike_count), 0), 2) AS like_dislike_ratio
FROM videos GROUP BY uploader ORDER BY total_views DESC, uploader LIMIT 10""",
)
def channels_top(t):
    return (
        videos(t)
        .groupBy("uploader")
        .agg(
            F.sum("view_count").alias("total_views"),
            F.sum("like_count").alias("total_likes"),
            F.sum("dislike_count").alias("total_dislikes"),
            round_to(ratio(F.sum("like_count"), F.sum("dislike_count")), 2).alias("like_dislike_ratio"),
        )
        .orderBy(F.desc("total_views"), "uploader")
        .limit(10)
    )


@query(
    "q_years",
    "AG-09 PF-09",
    f"""
WITH {VIDEOS}
SELECT CAST(year(upload_date) AS INTEGER) AS upload_year, count(*) AS videos_count, round_to(avg(view_count), 2) AS avg_views,
       round_to(avg(like_count), 2) AS avg_likes, round_to(avg(dislike_count), 4) AS avg_dislikes
FROM videos WHERE upload_date IS NOT NULL GROUP BY 1 ORDER BY 1""",
)
def years(t):
    return (
        videos(t)
        .filter(F.col("upload_date").isNotNull())
        .groupBy(F.year("upload_date").alias("upload_year"))
        .agg(
            F.count(F.lit(1)).alias("videos_count"),
            round_to(F.avg("view_count"), 2).alias("avg_views"),
            round_to(F.avg("like_count"), 2).alias("avg_likes"),
            round_to(F.avg("dislike_count"), 4).alias("avg_dislikes"),
        )
        .orderBy("upload_year")
    )


@query(
    "q_popularity",
    "PF-14 SL-05 AG-28",
    f"""
WITH {VIDEOS}
SELECT {band_sql("view_count", POPULARITY_BANDS, POPULARITY_ABOVE, closed=False)} AS popularity_category,
       count(*) AS video_count, round_to(avg(CAST(like_count AS DOUBLE) / dislike_count), 2) AS avg_like_ratio
FROM videos WHERE dislike_count > 0 GROUP BY 1""",
)
def popularity_report(t):
    order = [label for _, label in POPULARITY_BANDS] + [POPULARITY_ABOVE]
    return (
        videos(t)
        .filter("dislike_count > 0")
        .groupBy(popularity("view_count").alias("popularity_category"))
        .agg(
            F.count(F.lit(1)).alias("video_count"),
            round_to(F.avg(ratio("like_count", "dislike_count")), 2).alias("avg_like_ratio"),
        )
        .orderBy(rank_of("popularity_category", order))
    )


@query(
    "q_federated_join",
    "J10 SC-08",
    f"""
WITH {VIDEOS}, {_CATEGORIES}
SELECT v.uploader, c.main_category AS category, c.country AS region, v.view_count, v.like_count, v.dislike_count,
       round_to(CAST(v.like_count AS DOUBLE) / nullif(v.dislike_count, 0), 2) AS like_ratio
FROM videos v JOIN categories c ON v.uploader_id = c.uploader_id""",
)
def federated_join(t):
    local = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("category"), F.col("c_nationkey").alias("region")
    )
    v = _external(t).table("videos")
    return (
        v.join(local, v["uploader_id"] == local["key"])
        .select(
            "uploader",
            "category",
            "region",
            "view_count",
            "like_count",
            "dislike_count",
            round_to(ratio("like_count", "dislike_count"), 2).alias("like_ratio"),
        )
        .orderBy(F.desc("view_count"))
    )


@query(
    "q_ext_join",
    "J11",
    f"""
WITH {VIDEOS}, {_CATEGORIES}
SELECT title AS name, uploader AS channel, main_category AS topic, country AS land, view_count AS views, like_count AS likes
FROM categories NATURAL JOIN videos ORDER BY views DESC, name LIMIT 10""",
)
def ext_join(t):
    db = _external(t)
    return (
        db.table("videos")
        .join(db.table("categories"), "uploader_id")
        .select(
            F.col("title").alias("name"),
            F.col("uploader").alias("channel"),
            F.col("main_category").alias("topic"),
            F.col("country").alias("land"),
            F.col("view_count").alias("views"),
            F.col("like_count").alias("likes"),
        )
        .orderBy(F.desc("views"), "name")
        .limit(10)
    )


@query(
    "q_ext_view",
    "SO-06 AG-27 AG-10",
    f"""
WITH {VIDEOS}, disliked AS (SELECT * FROM videos WHERE dislike_count >= 1)
SELECT uploader AS channel, CAST(sum(1) AS BIGINT) AS n, CAST(sum(view_count) AS BIGINT) AS views,
       round_to(CAST(sum(like_count) AS DOUBLE) / sum(dislike_count), 2) AS likes_per_dislike, max(view_count) AS best
FROM disliked GROUP BY channel""",
)
def ext_view(t):
    view = f"channels_{uuid.uuid4().hex}"
    t.spark.sql(
        """SELECT uploader AS channel, count(*) AS n, sum(view_count) AS views, max(view_count) AS best,
                  try_divide(CAST(sum(like_count) AS DOUBLE), sum(dislike_count)) AS likes_per_dislike
           FROM {source} WHERE dislike_count > 0 GROUP BY channel HAVING n > 0""",
        source=_external(t).table("videos"),
    ).createTempView(view)
    top = t.spark.table(view).withColumn("likes_per_dislike", round_to("likes_per_dislike", 2))
    t.spark.catalog.dropTempView(view)
    return top.orderBy(F.desc("views"))


@query(
    "q_ext_cached",
    "MV-11",
    f"""
WITH {VIDEOS}
SELECT uploader, count(*) AS video_count, CAST(sum(view_count) AS BIGINT) AS total_views,
       CAST(sum(like_count) AS BIGINT) AS total_likes, CAST(sum(dislike_count) AS BIGINT) AS total_dislikes,
       round_to(CAST(sum(like_count) AS DOUBLE) / sum(dislike_count), 2) AS like_ratio
FROM videos WHERE dislike_count > 0 GROUP BY uploader""",
)
def ext_cached(t):
    summary = (
        _external(t)
        .table("videos")
        .filter("dislike_count > 0")
        .groupBy("uploader")
        .agg(
            F.count(F.lit(1)).alias("video_count"),
            F.sum("view_count").alias("total_views"),
            F.sum("like_count").alias("total_likes"),
            F.sum("dislike_count").alias("total_dislikes"),
            round_to(ratio(F.sum("like_count"), F.sum("dislike_count")), 2).alias("like_ratio"),
        )
    )
    return create_as(summary, new_path(t.spark, "channel-summary"))


@query(
    "q_ext_totals",
    "AG-02",
    f"""
WITH {VIDEOS}
SELECT count(*) AS total_videos, CAST(sum(view_count) AS BIGINT) AS total_views, round_to(avg(view_count), 2) AS avg_views,
       max(view_count) AS max_views, min(view_count) AS min_views FROM videos""",
)
def ext_totals(t):
    return (
        _external(t)
        .table("videos")
        .agg(
            F.count(F.lit(1)).alias("total_videos"),
            F.sum("view_count").alias("total_views"),
            round_to(F.avg("view_count"), 2).alias("avg_views"),
            F.max("view_count").alias("max_views"),
            F.min("view_count").alias("min_views"),
        )
    )


@query(
    "q_ext_by_channel",
    "AG-28",
    f"""
WITH {VIDEOS}
SELECT uploader, count(*) AS video_count, CAST(sum(view_count) AS BIGINT) AS total_views,
       round_to(avg(CAST(like_count AS DOUBLE) / dislike_count), 2) AS avg_like_ratio
FROM videos WHERE dislike_count > 0 GROUP BY uploader ORDER BY total_views DESC, uploader LIMIT 10""",
)
def ext_by_channel(t):
    return (
        _external(t)
        .table("videos")
        .filter("dislike_count > 0")
        .groupBy("uploader")
        .agg(
            F.count(F.lit(1)).alias("video_count"),
            F.sum("view_count").alias("total_views"),
            round_to(F.avg(ratio("like_count", "dislike_count")), 2).alias("avg_like_ratio"),
        )
        .orderBy(F.desc("total_views"), "uploader")
        .limit(10)
    )


@query(
    "q_ext_filtered",
    "PF-03 SL-02",
    f"""
WITH {VIDEOS}
SELECT view_count AS views, title AS name, uploader AS channel, like_count AS likes, dislike_count AS dislikes
FROM videos WHERE NOT view_count <= {MANY_VIEWS} ORDER BY 1 DESC, 2 LIMIT 10""",
)
def ext_filtered(t):
    return (
        _external(t)
        .table("videos")
        .filter(F.col("view_count") > MANY_VIEWS)
        .selectExpr(*_SHORT)
        .orderBy(F.desc("views"), "name")
        .limit(10)
    )


@query(
    "q_ext_since",
    "AG-09",
    f"""
WITH {VIDEOS}
SELECT CAST(year(upload_date) AS INTEGER) AS year, count(*) AS videos_per_year,
       CAST(sum(view_count) AS BIGINT) AS total_views_per_year
FROM videos WHERE upload_date >= DATE '1998-01-01' GROUP BY 1 ORDER BY 1""",
)
def ext_since(t):
    return (
        _external(t)
        .table("videos")
        .filter(F.col("upload_date") >= F.lit(dt.date(1998, 1, 1)))
        .groupBy(F.year("upload_date").alias("year"))
        .agg(F.count(F.lit(1)).alias("videos_per_year"), F.sum("view_count").alias("total_views_per_year"))
        .orderBy("year")
    )


@query(
    "q_ext_three_ways",
    "SC-08 SO-01",
    f"""
WITH {VIDEOS}, n AS (SELECT count(*) AS records FROM videos WHERE view_count > 1000000)
SELECT 'function' AS method, records FROM n UNION ALL SELECT 'table', records FROM n
UNION ALL SELECT 'database', records FROM n""",
)
def ext_three_ways(t):
    by_function = read_external(t.spark, _external(t).path, "videos")
    by_function.createOrReplaceTempView("videos_by_name")
    ways = {"function": by_function, "table": t.spark.table("videos_by_name"), "database": _external(t).table("videos")}
    out = None
    for name, df in ways.items():
        one = df.filter("view_count > 1000000").agg(F.count(F.lit(1)).alias("records"))
        one = one.select(F.lit(name).alias("method"), "records")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "q_pg_summary",
    "AG-02",
    f"""
WITH {VIDEOS}
SELECT count(*) AS total_videos, round_to(avg(view_count), 2) AS avg_views, round_to(avg(like_count), 2) AS avg_likes,
       round_to(avg(dislike_count), 4) AS avg_dislikes FROM videos""",
)
def pg_summary(t):
    return videos(t).agg(
        F.count(F.lit(1)).alias("total_videos"),
        round_to(F.avg("view_count"), 2).alias("avg_views"),
        round_to(F.avg("like_count"), 2).alias("avg_likes"),
        round_to(F.avg("dislike_count"), 4).alias("avg_dislikes"),
    )


@query(
    "q_pg_top5",
    "SL-02",
    f"""
WITH {VIDEOS}
SELECT view_count AS views, title AS name, uploader AS channel, like_count AS likes, dislike_count AS dislikes
FROM videos ORDER BY views DESC, name LIMIT 5""",
)
def pg_top5(t):
    return (
        videos(t)
        .selectExpr(*_SHORT)
        .orderBy(F.desc("views"), "name")
        .limit(5)
    )


@query(
    "q_channels_rounded",
    "FN-19 AG-05",
    f"""
WITH {VIDEOS}
SELECT uploader, count(*) AS videos, CAST(sum(view_count) AS BIGINT) AS total_views, round_to(avg(like_count), 0) AS avg_likes,
       round_to(avg(dislike_count), 0) AS avg_dislikes
FROM videos GROUP BY uploader ORDER BY total_views DESC, uploader LIMIT 10""",
)
def channels_rounded(t):
    return (
        videos(t)
        .groupBy("uploader")
        .agg(
            F.count(F.lit(1)).alias("videos"),
            F.sum("view_count").alias("total_views"),
            round_to(F.avg("like_count"), 0).alias("avg_likes"),
            round_to(F.avg("dislike_count"), 0).alias("avg_dislikes"),
        )
        .orderBy(F.desc("total_views"), "uploader")
        .limit(10)
    )


@query(
    "q_staged_subset",
    "PF-20",
    """
SELECT o_orderkey, o_totalprice, o_orderstatus
FROM (SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1000) s
WHERE o_totalprice > 200000 AND o_orderstatus <> 'P'""",
)
def staged_subset(t):
    wanted = (F.col("o_totalprice") > 200000) & (F.col("o_orderstatus") != "P")
    return limit_then_filter(t.orders, ["o_orderdate", "o_orderkey"], 1000, wanted).select(
        "o_orderkey", "o_totalprice", "o_orderstatus"
    )


@query(
    "q_like_ratio_topk",
    "SL-02 PF-06 FN-22",
    """
SELECT p_name AS title, l_orderkey, l_linenumber, l_extendedprice AS view_count, l_quantity AS like_count,
       round_to(l_extendedprice / l_quantity, 2) AS ratio
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_name ILIKE '%RING%' AND l_extendedprice > 1000 AND l_quantity > 0
ORDER BY ratio DESC, l_orderkey, l_linenumber, view_count LIMIT 5""",
)
def like_ratio_topk(t):
    part = t.part.filter(F.col("p_name").ilike("%RING%")).select("p_partkey", "p_name")
    return (
        t.lineitem.filter("l_extendedprice > 1000 AND l_quantity > 0")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("p_name").alias("title"),
            "l_orderkey",
            "l_linenumber",
            F.col("l_extendedprice").alias("view_count"),
            F.col("l_quantity").alias("like_count"),
            round_to(ratio("l_extendedprice", "l_quantity"), 2).alias("ratio"),
        )
        .orderBy(F.desc("ratio"), "l_orderkey", "l_linenumber", "view_count")
        .limit(5)
    )


@query(
    "q_monthly_median",
    "AG-14 PF-19 AG-06",
    f"""
WITH {VIDEOS}
SELECT strftime(date_trunc('month', upload_date), '%Y-%m-%d') AS month, count(*) AS video_count,
       CAST(sum(view_count) AS BIGINT) AS total_views, quantile_disc(like_count, 0.5) AS median_likes
FROM videos WHERE upload_date >= DATE '1997-01-01' AND upload_date < DATE '1998-01-01'
GROUP BY 1 ORDER BY 1""",
)
def monthly_median(t):
    rows = (
        videos(t)
        .filter(in_year("upload_date", 1997))
        .select(F.date_format("upload_date", "yyyy-MM-01").alias("month"), "view_count", "like_count")
    )
    totals = rows.groupBy("month").agg(F.count(F.lit(1)).alias("video_count"), F.sum("view_count").alias("total_views"))
    median = exact_quantiles(rows, ["month"], "like_count", {"median_likes": 0.5})
    return totals.join(median, "month", "left").orderBy("month")
