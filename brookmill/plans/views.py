"""Shapes the reference queries expect, over the shared tables.

Each has a Spark form and the same thing as a SQL common table expression.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmill.sources.tables import Tables

# "Now" for every query with a relative time filter.
AS_OF = dt.datetime(2024, 1, 31)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def event_k(t: Tables) -> DataFrame:
    """Events with the number inside ``props``."""
    return t.events.withColumn("k", F.from_json("props", "k int")["k"])


EVENT_K = "event_k AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"


def sensors(t: Tables) -> DataFrame:
    k, user = F.col("k"), F.col("user_id")
    return event_k(t).select(
        user.alias("sensor_id"),
        F.col("event_type").alias("sensor_type"),
        (user % 20).alias("location"),
        ((user % 7).cast("double") * 1.5).alias("lat"),
        ((user % 11).cast("double") * 2.0).alias("lon"),
        F.col("ts").alias("timestamp"),
        k.cast("double").alias("p1"),
        F.col("value").alias("p2"),
        F.when(k % 10 == 0, None).otherwise(k.cast("double") - 40).alias("temperature"),
        F.when(k % 7 == 0, None).otherwise(((k * 37) % 101).cast("double")).alias("humidity"),
        (user % 100 + 950).cast("double").alias("pressure"),
    )


SENSORS = (
    EVENT_K
    + """,
sensors AS (
  SELECT user_id AS sensor_id, event_type AS sensor_type, user_id % 20 AS location,
         CAST(user_id % 7 AS DOUBLE) * 1.5 AS lat, CAST(user_id % 11 AS DOUBLE) * 2.0 AS lon,
         ts AS timestamp, CAST(k AS DOUBLE) AS p1, value AS p2,
         CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(k AS DOUBLE) - 40 END AS temperature,
         CASE WHEN k % 7 = 0 THEN NULL ELSE CAST((k * 37) % 101 AS DOUBLE) END AS humidity,
         CAST(user_id % 100 + 950 AS DOUBLE) AS pressure
  FROM event_k)"""
)


def metrics(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("ts").alias("collected_at"),
        F.concat(F.lit("host"), (F.col("user_id") % 4).cast("string")).alias("host"),
        F.col("event_type").alias("metric_name"),
        F.col("value").alias("metric_value"),
    )


METRICS = """metrics AS (
  SELECT ts AS collected_at, 'host' || CAST(user_id % 4 AS VARCHAR) AS host,
         event_type AS metric_name, value AS metric_value
  FROM events)"""


def cases(t: Tables) -> DataFrame:
    """Daily cases per place."""
    return t.events.select(
        F.col("event_id"),
        F.to_date("ts").alias("date"),
        F.concat(F.lit("L"), F.col("user_id").cast("string")).alias("location_key"),
        F.floor("value").cast("long").alias("new_confirmed"),
        F.col("ts"),
    )


CASES = """cases AS (
  SELECT event_id, CAST(ts AS DATE) AS date, 'L' || CAST(user_id AS VARCHAR) AS location_key,
         CAST(floor(value) AS BIGINT) AS new_confirmed, ts
  FROM events)"""


def videos(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.col("o_orderpriority"), F.lit(" #"), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_custkey").alias("uploader_id"),
        F.concat(F.lit("channel_"), F.col("o_custkey").cast("string")).alias("uploader"),
        F.col("o_orderdate").alias("upload_date"),
        F.floor(price * price / 1000).cast("long").alias("view_count"),
        F.floor(price).cast("long").alias("like_count"),
        (F.col("o_custkey") % 50).alias("dislike_count"),
    )


VIDEOS = """videos AS (
  SELECT o_orderkey AS id, o_orderpriority || ' #' || CAST(o_orderkey AS VARCHAR) AS title,
         o_custkey AS uploader_id, 'channel_' || CAST(o_custkey AS VARCHAR) AS uploader,
         o_orderdate AS upload_date,
         CAST(floor(o_totalprice * o_totalprice / 1000) AS BIGINT) AS view_count,
         CAST(floor(o_totalprice) AS BIGINT) AS like_count,
         o_custkey % 50 AS dislike_count
  FROM orders)"""


def sales(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("sale_date"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("month"),
    )


SALES = """sales AS (
  SELECT l_orderkey AS id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice AS price, l_shipdate AS sale_date,
         CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS month
  FROM lineitem)"""


def logs(t: Tables) -> DataFrame:
    """Log rows: one per event."""
    return event_k(t).select(
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "signup", "WARNING")
        .when(F.col("event_type") == "purchase", "INFORMATION")
        .otherwise("DEBUG")
        .alias("level"),
        F.col("event_type").alias("logger_name"),
        F.concat(
            F.lit("Event message #"), F.col("event_id").cast("string"), F.lit(" from user "), F.col("user_id").cast("string")
        ).alias("message"),
        F.col("k").cast("long").alias("thread_id"),
        F.concat(F.lit("replica-"), (F.col("user_id") % 4).cast("string")).alias("replica_name"),
        (F.col("user_id") % 2 + 1).cast("int").alias("replica_shard"),
        ((F.col("user_id") % 4 - F.col("user_id") % 2) / 2 + 1).cast("int").alias("replica_num"),
    )


LOGS = (
    EVENT_K
    + """,
logs AS (
  SELECT ts AS timestamp,
         CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARNING'
              WHEN event_type = 'purchase' THEN 'INFORMATION' ELSE 'DEBUG' END AS level,
         event_type AS logger_name,
         'Event message #' || CAST(event_id AS VARCHAR) || ' from user ' || CAST(user_id AS VARCHAR) AS message,
         CAST(k AS BIGINT) AS thread_id,
         'replica-' || CAST(user_id % 4 AS VARCHAR) AS replica_name,
         CAST(user_id % 2 + 1 AS INTEGER) AS replica_shard,
         CAST((user_id % 4 - user_id % 2) // 2 + 1 AS INTEGER) AS replica_num
  FROM event_k)"""
)
