"""Row, partition and schema changes on an activity table partitioned by day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.functions.hashing import stable_sql
from brookmill.functions.dates import in_range, yyyymmdd
from brookmill.operators import positions as M
from brookmill.operators import tables as W
from brookmill.plans.registry import query
from brookmill.plans.views import AS_OF
from brookmill.scratch import new_path

SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("activity_type", T.StringType()),
        T.StructField("activity_date", T.TimestampNTZType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("day", T.IntegerType()),
    ]
)


def _rows(t):
    return t.events.select(
        "event_id",
        "user_id",
        F.col("event_type").alias("activity_type"),
        F.col("ts").alias("activity_date"),
        "value",
        yyyymmdd("ts").alias("day"),
    )


def _stored(t, name: str, rows=None) -> W.Folder:
    folder = W.Folder(t.spark, new_path(t.spark, name), SCHEMA, ("day",))
    W.append(folder, _rows(t) if rows is None else rows)
    return folder


_ACTIVITY = """activity AS (
  SELECT event_id, user_id, event_type AS activity_type, ts AS activity_date, value,
         CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day FROM events)"""
_TEN_DAYS = "activity_date >= TIMESTAMP '2024-01-10' AND activity_date < TIMESTAMP '2024-01-20'"


def _ten_days():
    return in_range("activity_date", dt.date(2024, 1, 10), dt.date(2024, 1, 20))


@query(
    "q_activity_after_update",
    "MU-02 SK-02",
    f"""
WITH {_ACTIVITY}
SELECT event_id, user_id, CASE WHEN {_TEN_DAYS} AND activity_type = 'signup' THEN 'view' ELSE activity_type END AS activity_type,
       activity_date, value, day FROM activity""",
)
def activity_after_update(t):
    folder = _stored(t, "activity")
    W.update_where(folder, _ten_days() & (F.col("activity_type") == "signup"), {"activity_type": F.lit("view")})
    return folder.read()


@query(
    "q_activity_after_delete",
    "MU-03",
    f"""
WITH {_ACTIVITY}
SELECT * FROM activity
WHERE NOT ({_TEN_DAYS} AND activity_type = 'purchase')
  AND NOT (activity_date >= TIMESTAMP '2024-01-25' AND activity_date < TIMESTAMP '2024-01-26')""",
)
def activity_after_delete(t):
    folder = _stored(t, "activity")
    W.delete_where(folder, _ten_days() & (F.col("activity_type") == "purchase"))
    W.delete_where(folder, in_range("activity_date", dt.date(2024, 1, 25), dt.date(2024, 1, 26)))
    return folder.read()


@query(
    "q_activity_after_replace",
    "MU-08",
    f"""
WITH {_ACTIVITY}
SELECT event_id, user_id, CASE WHEN day = 20240115 THEN 'signup' ELSE activity_type END AS activity_type,
       activity_date, value, day FROM activity""",
)
def activity_after_replace(t):
    folder = _stored(t, "activity")
    staged = W.create_as(
        folder.read().filter("day = 20240115").withColumn("activity_type", F.lit("signup")), new_path(t.spark, "staged")
    )
    W.replace_partition(folder, {"day": 20240115}, staged)
    return folder.read()


@query(
    "q_activity_after_drop",
    "MU-06",
    f"WITH {_ACTIVITY} SELECT * FROM activity WHERE day <> 20240120",
)
def activity_after_drop(t):
    folder = _stored(t, "activity")
    W.drop_partition(folder, {"day": 20240120})
    return folder.read()


@query(
    "activity_counts",
    "MU-13 MU-02",
    f"""
WITH {_ACTIVITY}
SELECT CASE WHEN activity_type = 'signup' THEN 'view' ELSE activity_type END AS activity_type, count(*) AS n
FROM activity WHERE {_TEN_DAYS} GROUP BY 1""",
)
def activity_counts(t):
    changed = activity_after_update(t)
    return changed.filter(_ten_days()).groupBy("activity_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "activity_insert",
    "MU-01 SK-01",
    f"WITH {_ACTIVITY} SELECT * FROM activity UNION ALL SELECT * FROM activity WHERE activity_type = 'error'",
)
def activity_insert(t):
    folder = _stored(t, "activity")
    W.append(folder, _rows(t).filter("activity_type = 'error'"))
    return folder.read()


@query(
    "activity_attach_all",
    "MU-09",
    f"WITH {_ACTIVITY} SELECT * FROM activity",
)
def activity_attach_all(t):
    source = _stored(t, "activity")
    clone = W.Folder(t.spark, new_path(t.spark, "clone"), SCHEMA, ("day",))
    W.attach_all(clone, source)
    return clone.read()


@query(
    "activity_expire",
    "MU-12",
    f"WITH {_ACTIVITY} SELECT * FROM activity WHERE activity_date >= TIMESTAMP '2024-01-15 06:00:00'",
)
def activity_expire(t):
    folder = _stored(t, "activity")
    W.expire(folder, "activity_date", 16, AS_OF + dt.timedelta(hours=6), day_number="day")
    return folder.read()


@query(
    "activity_new_columns",
    "MU-04 MU-05 MU-14",
    f"""
WITH {_ACTIVITY}
SELECT event_id, user_id, activity_type, activity_date, day, CAST(0 AS INTEGER) AS calories, 'none' AS note FROM activity
UNION ALL
SELECT event_id, user_id, activity_type, activity_date, day, CAST(80 AS INTEGER), 'none' FROM activity WHERE activity_type = 'view'""",
)
def activity_new_columns(t):
    folder = _stored(t, "activity")
    new = {"calories": ("int", 0), "note": ("string", "none")}
    wide = T.StructType([f for f in SCHEMA if f.name != "value"] + [T.StructField("calories", T.IntegerType())])
    late = _rows(t).filter("activity_type = 'view'").withColumn("calories", F.lit(80))
    W.append(W.Folder(t.spark, folder.path, wide, ("day",)), late)
    return W.evolved(folder, new, dropped=("value",))


@query(
    "partition_report",
    "IN-01 SK-02",
    f"WITH {_ACTIVITY} SELECT day, count(*) AS total_rows, TRUE AS parts_known FROM activity GROUP BY 1",
)
def partition_report(t):
    from brookmill.operators.reports import partition_report as report

    folder = _stored(t, "activity")
    stored = t.spark.read.schema(SCHEMA).parquet(folder.path)
    found = report(stored, ["day"])
    parts = {r["day"]: r["parts_count"] for r in found.collect()}
    files = stored.select("day", F.col("_metadata.file_path").alias("f")).distinct().groupBy("day").count().collect()
    known = all(parts[r["day"]] == r["count"] > 0 for r in files)
    return found.select("day", "total_rows", F.lit(known).alias("parts_known"))


@query("partition_list", "IN-02", f"WITH {_ACTIVITY} SELECT DISTINCT day FROM activity")
def partition_list(t):
    return W.list_partitions(_stored(t, "activity"))


_SIZED = ("orders", "lineitem", "events", "customer")


@query(
    "table_sizes",
    "IN-05",
    "\nUNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS total_rows, TRUE AS stored FROM {n}" for n in _SIZED),
)
def table_sizes(t):
    """Rows per table, and whether its files and bytes are known."""
    from brookmill.operators.reports import table_sizes as sizes

    found = sizes({name: getattr(t, name) for name in _SIZED})
    return found.select("table", "total_rows", ((F.col("files") > 0) & (F.col("total_bytes") > 0)).alias("stored"))


@query(
    "shard_skew",
    "IN-03",
    f"""
WITH k AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST({stable_sql("o_custkey")} % 16 AS INTEGER) AS shard, CAST(sum(n) AS BIGINT) AS records, count(*) AS keys,
       max(n) AS heaviest_key FROM k GROUP BY 1""",
)
def shard_skew(t):
    """Rows, keys and heaviest key per hash shard."""
    from brookmill.operators.reports import shard_report

    return shard_report(t.orders, "o_custkey", 16)


@query(
    "shard_total",
    "IN-03",
    "SELECT count(*) AS records, count(DISTINCT o_custkey) AS keys FROM orders",
)
def shard_total(t):
    return shard_skew(t).agg(F.sum("records").alias("records"), F.sum("keys").alias("keys"))


def _marked(t) -> M.MarkedFolder:
    folder = M.MarkedFolder(t.spark, new_path(t.spark, "activity-marked"), SCHEMA, ("day",))
    W.append(folder, _rows(t))
    return folder


@query(
    "activity_marked_delete",
    "MU-03",
    f"WITH {_ACTIVITY} SELECT * FROM activity WHERE NOT coalesce(({_TEN_DAYS} AND value < 50) OR event_id % 97 = 5, FALSE)",
)
def activity_marked_delete(t):
    """Two deletes note places of rows; no data file is written."""
    folder = _marked(t)
    M.delete_rows(folder, _ten_days() & (F.col("value") < 50))
    M.delete_rows(folder, F.col("event_id") % 97 == 5)
    return folder.read()


@query(
    "activity_marked_update",
    "MU-02",
    f"""
WITH {_ACTIVITY}
SELECT * REPLACE (CASE WHEN {_TEN_DAYS} AND activity_type = 'view' THEN value * 2 ELSE value END AS value) FROM activity
WHERE NOT coalesce(event_id % 101 = 7, FALSE)""",
)
def activity_marked_update(t):
    """Changed rows are written anew and their old places noted; a delete after it and a compaction change nothing else."""
    folder = _marked(t)
    M.update_rows(folder, _ten_days() & (F.col("activity_type") == "view"), {"value": F.col("value") * 2})
    M.delete_rows(folder, F.col("event_id") % 101 == 7)
    M.compact(folder)
    return folder.read()
