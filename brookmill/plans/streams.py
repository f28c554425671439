"""Streams over a topic made from the events table, and load checks."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from brookmill.functions.hashing import stable_sql
from brookmill.functions.types import round_to
from pyspark.sql import types as T

from brookmill.functions.dates import start_of, yyyymm
from brookmill.functions.hashing import row_digest
from brookmill.operators import checks as C
from brookmill.operators import rollups as R
from brookmill.operators import tables as W
from brookmill.operators.batches import path_stats
from brookmill.operators.joins import lookup
from brookmill.plans.logs import ALERT_NOW, ALERTS_SQL
from brookmill.plans.registry import query
from brookmill.plans.views import CASES, EVENT_K, LOGS, event_k, logs
from brookmill.scratch import cut, new_path
from brookmill.sources import topics as K
from brookmill.streaming import dedup, ingest, marks
from brookmill.streaming import typing as Ty
from brookmill.streaming.alerts import threshold_alerts
from brookmill.streaming.hours import HourlySums
from brookmill.streaming.pinned import PinnedDictionary

BODY = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("date", T.StringType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("location_key", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("new_confirmed", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _body(t):
    return t.events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
        F.concat(F.lit("L"), F.col("user_id").cast("string")).alias("location_key"),
        "event_type",
        F.floor("value").cast("long").alias("new_confirmed"),
        "value",
        "ts",
    )


def _topic(t, broken: bool = False) -> str:
    """Folder of topic rows, one message per event. With ``broken`` the first 'error' messages are cut short."""
    body = F.to_json(F.struct(*[f.name for f in BODY]))
    if broken:
        body = F.when((F.col("event_type") == "error") & (F.col("event_id") < 1000), F.substring(body, 1, 30)).otherwise(body)
    messages = _body(t).select(K.message_key("location_key", "date").alias("key"), body.alias("value"), "ts", "event_id")
    path = new_path(t.spark, "topic")
    K.as_topic_rows(messages, F.col("ts"), F.col("event_id")).write.parquet(path)
    return path


#: Files a micro-batch takes at most, so that the first one is no larger than the others.
FILES_PER_BATCH = 64


def _stream(t, topic: str | None = None):
    return K.read_stream(t.spark, "parquet", K.TOPIC_SCHEMA, path=topic or _topic(t), maxFilesPerTrigger=FILES_PER_BATCH)


_TYPED_SQL = f"""
WITH {CASES}
SELECT e.event_id, strftime(ts, '%Y-%m-%d') AS date, ts AS event_time, 'L' || user_id AS location_key, event_type,
       CAST(floor(value) AS BIGINT) AS new_confirmed, value, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS ym FROM events e"""


def _shown(df):
    """Dates as text and times without zone, so both engines return the same types."""
    out = []
    for f in df.schema:
        kind = {"date": "string", "timestamp": "timestamp_ntz"}.get(f.dataType.typeName())
        out.append(F.col(f.name).cast(kind).alias(f.name) if kind else F.col(f.name))
    return df.select(*out)


def _typed(decoded):
    good = Ty.non_empty_dates(decoded.drop("_corrupt"))
    typed = Ty.typed_select(good)
    return typed.withColumn("ym", yyyymm("date"))


@query("stream_typed_table", "ST-01 ST-02 ST-04 SC-14", _TYPED_SQL)
def stream_typed_table(t):
    decoded = K.decode(_stream(t), BODY).filter("_corrupt IS NULL")
    path = new_path(t.spark, "typed")
    typed = _typed(decoded)
    ingest.to_table(typed, path, new_path(t.spark, "cp"), ["ym"])
    return _shown(t.spark.read.schema(typed.schema).parquet(path).select(*typed.columns))


#: Fixed value: broken messages that one batch may hold.
MOST_BROKEN = 1000


@query(
    "stream_broken_messages",
    "ST-03",
    """
SELECT 'good' AS part, count(*) AS n, TRUE AS refused_above FROM events WHERE NOT coalesce(event_type = 'error' AND event_id < 1000, FALSE)
UNION ALL SELECT 'broken', count(*), TRUE FROM events WHERE event_type = 'error' AND event_id < 1000""",
)
def stream_broken_messages(t):
    """Good rows go to the table, broken messages to a side table, up to a fixed number in a batch. Of a second topic, with
    one broken message more than that, the batch fails and nothing is stored."""
    good_path, bad_path = new_path(t.spark, "good"), new_path(t.spark, "broken")

    def split(df, batch):
        decoded = K.decode(df, BODY)
        Ty.require_few_corrupt(decoded, MOST_BROKEN)
        good, bad = Ty.split_corrupt(decoded)
        for part, path in ((good, good_path), (bad, bad_path)):
            part.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    worse = t.spark.read.schema(K.TOPIC_SCHEMA).parquet(_topic(t)).limit(1)
    worse = worse.withColumn("value", F.lit("{")).withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(MOST_BROKEN)).cast("array<bigint>")))
    worse_path = new_path(t.spark, "worse-topic")
    worse.write.parquet(worse_path)
    try:
        ingest.run_available(_stream(t, worse_path), new_path(t.spark, "cp"), split)
        refused = False
    except StreamingQueryException:
        refused = not W.exists(t.spark, good_path) and not W.exists(t.spark, bad_path)
    ingest.run_available(_stream(t, _topic(t, broken=True)), new_path(t.spark, "cp"), split)
    out = None
    for name, path in (("good", good_path), ("broken", bad_path)):
        one = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n", F.lit(refused).alias("refused_above"))
        out = one if out is None else out.unionByName(one)
    return out


_NOW = dt.datetime(2024, 2, 1)


@query(
    "stream_manual_batch",
    "SC-15 ST-11 ST-12 FN-37",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, 'L' || user_id AS location_key, 'batch-1' AS batch_id,
       event_id AS kafka_offset, TIMESTAMP '2024-02-01' AS processing_time, 'manual' AS consumer_group_id,
       CAST(epoch(TIMESTAMP '2024-02-01') AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) AS lag_seconds FROM events""",
)
def stream_manual_batch(t):
    rows = K.read_batch(t.spark, "parquet", K.TOPIC_SCHEMA, path=_topic(t))
    decoded = K.decode(rows, BODY, keep=["partition", "offset", "timestamp"]).filter("_corrupt IS NULL")
    day = F.try_to_date("date", "yyyy-MM-dd").cast("string").alias("date")
    audited = ingest.audit_columns(
        decoded.select("event_id", day, "location_key", "partition", "offset", "timestamp"), "batch-1", "manual", _NOW
    )
    return _shown(audited.drop("kafka_partition"))


@query(
    "topic_offset_batches",
    "SC-15 ST-11",
    """
SELECT event_id, CASE WHEN event_id < h.half THEN 1 ELSE 2 END AS batch, TRUE AS same_again
FROM events, (SELECT CAST(floor((min(event_id) + max(event_id)) / 2) AS BIGINT) AS half FROM events) h""",
)
def topic_offset_batches(t):
    """Two batches by stored offset ranges. The first is planned while half of the topic is there, and read again after
    the rest has come: it gives the rows it gave before."""
    whole = t.spark.read.schema(K.TOPIC_SCHEMA).parquet(_topic(t))
    ends = whole.agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).first()
    half, path = ((ends["lo"] or 0) + (ends["hi"] or 0)) // 2, new_path(t.spark, "growing-topic")
    topic = lambda: t.spark.read.schema(K.TOPIC_SCHEMA).parquet(path)
    log = new_path(t.spark, "offset-ranges")
    whole.filter(F.col("offset") < half).write.parquet(path)
    early = K.OffsetBatches(topic(), log)
    early.plan(1)
    before = cut(early.read(1).select("offset"), "first-read")
    whole.filter(F.col("offset") >= half).write.mode("append").parquet(path)
    batches = K.OffsetBatches(topic(), log)
    batches.plan(1)
    batches.plan(2)
    again = batches.read(1).select("offset")
    same = before.exceptAll(again).isEmpty() and again.exceptAll(before).isEmpty()
    both = [K.decode(batches.read(b), BODY).select("event_id", F.lit(b).alias("batch"), F.lit(same).alias("same_again")) for b in (1, 2)]
    return both[0].unionByName(both[1])


@query("stream_incremental_files", "SC-16", "SELECT event_id, user_id, event_type, value FROM events")
def stream_incremental_files(t):
    """Files found in rounds of two, oldest first, until none is new."""
    folder, out = new_path(t.spark, "incoming"), new_path(t.spark, "collected")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    rows.repartition(5).write.options(header=True).csv(folder)
    found = (
        t.spark.readStream.schema(rows.schema)
        .options(header=True, maxFilesPerTrigger=2, latestFirst=False, pathGlobFilter="*.csv")
        .csv(folder)
    )
    ingest.run_available(found, new_path(t.spark, "cp"), ingest.batch_writer(out))
    return t.spark.read.parquet(out).select(*rows.columns)


@query("load_by_mark", "ST-05 ST-06", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def load_by_mark(t):
    """Loaded in about three steps; no row is lost or taken twice."""
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    out, mark = new_path(t.spark, "loaded"), new_path(t.spark, "mark")
    size = math.ceil(rows.count() / 3)
    while marks.load_step(rows, "o_orderdate", "o_orderkey", out, mark, limit=size):
        pass
    return t.spark.read.schema(rows.schema).parquet(out).select(*rows.columns)


@query("load_by_plan", "ST-05 ST-06", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate IS NOT NULL")
def load_by_plan(t):
    """The ends of all steps are found at once; every step reads its own range."""
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    out, plan = new_path(t.spark, "loaded"), new_path(t.spark, "load-plan")
    size = math.ceil(rows.count() / 5)
    for step in range(marks.plan_steps(rows, "o_orderdate", plan, size)):
        marks.load_planned(rows, "o_orderdate", out, plan, step)
    return t.spark.read.schema(rows.schema).parquet(out).select(*rows.columns)


@query("load_by_manual_mark", "ST-05", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-30'")
def load_by_manual_mark(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    out, mark = new_path(t.spark, "loaded"), new_path(t.spark, "mark")
    marks.load_step(rows, "o_orderdate", "o_orderkey", out, mark, manual=dt.datetime(2000, 6, 30))
    return t.spark.read.schema(rows.schema).parquet(out).select(*rows.columns)


@query("dedup_batch", "ST-07 FN-28", "SELECT DISTINCT user_id, event_type, CAST(floor(value) AS BIGINT) AS v FROM events")
def dedup_batch(t):
    rows = t.events.select("user_id", "event_type", F.floor("value").cast("long").alias("v"))
    return dedup.drop_repeats(rows).drop("record_hash")


@query("dedup_stream", "ST-07", "SELECT event_id, event_type, value FROM events")
def dedup_stream(t):
    """The topic is read twice over; the second copy of every message is dropped."""
    topic = _topic(t)
    twice = _stream(t, topic).unionByName(_stream(t, topic))
    decoded = _typed(K.decode(twice, BODY).filter("_corrupt IS NULL"))
    unique = dedup.drop_repeats_stream(decoded, "event_time", ["event_id", "event_type", "value"], memory="40 days")
    path = new_path(t.spark, "unique")
    ingest.to_table(unique, path, new_path(t.spark, "cp"), ["ym"])
    return t.spark.read.schema(unique.schema).parquet(path).select("event_id", "event_type", "value")


@query(
    "normalised_records",
    "ST-08 FN-28",
    f"""
WITH {EVENT_K}
SELECT event_id, coalesce(CASE WHEN k % 5 = 0 THEN NULL ELSE value END, 0.0) AS temperature,
       CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS sensor_type
FROM event_k WHERE event_type <> 'error'""",
)
def normalised_records(t):
    rows = event_k(t).select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("ts")).alias("timestamp"),
        F.when(F.col("k") % 5 != 0, F.col("value")).alias("temperature"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("sensor_type"),
    )
    return Ty.normalise(rows, "timestamp", ["temperature"], {"sensor_type": ""}).select(
        "event_id", "temperature", "sensor_type"
    )


@query(
    "split_streams",
    "ST-09",
    f"""
WITH {EVENT_K}
SELECT 'new' AS stream, event_id, CAST(floor(value) AS BIGINT) AS confirmed FROM event_k
UNION ALL SELECT 'cumulative', event_id, CAST(k AS BIGINT) FROM event_k""",
)
def split_streams(t):
    rows = event_k(t).select("event_id", F.floor("value").cast("long").alias("nc"), F.col("k").cast("long").alias("cc"))
    parts = Ty.project_streams(rows, ["event_id"], {"new": {"confirmed": "nc"}, "cumulative": {"confirmed": "cc"}})
    tagged = [df.select(F.lit(n).alias("stream"), "event_id", "confirmed") for n, df in parts.items()]
    return tagged[0].unionByName(tagged[1])


@query(
    "stream_alerts",
    "ST-10 SK-07",
    f"""
WITH {CASES}, alerts AS ({ALERTS_SQL})
SELECT location_key AS key, '{{"alert_time":"' || strftime(alert_time, '%Y-%m-%dT%H:%M:%S.%g') || '","location_key":"' || location_key
       || '","alert_type":"HIGH_CASES","threshold_value":100,"actual_value":'
       || actual_value || ',"message":"' || message || '"}}' AS value FROM alerts""",
)
def stream_alerts(t):
    """Typed stream to a stored table, alerts over it, alerts to an outgoing topic."""
    stored = stream_typed_table(t).withColumn("date", F.to_date("date"))
    found = threshold_alerts(stored, "location_key", "date", "new_confirmed", 100, ALERT_NOW)
    fields = ["alert_time", "location_key", "alert_type", "threshold_value", "actual_value", "message"]
    out = new_path(t.spark, "alerts")
    K.write_messages(K.to_messages(found, F.col("location_key"), fields), "parquet", path=out)
    return t.spark.read.schema("key string, value string").parquet(out)


@query(
    "compare_paths",
    "ST-13 SO-01",
    """
SELECT 'stream' AS method, count(*) AS total_records, count(DISTINCT user_id) AS unique_keys, min(ts) AS earliest, max(ts) AS latest
FROM events WHERE event_type IN ('click', 'view')
UNION ALL
SELECT 'manual', count(*), count(DISTINCT user_id), min(ts), max(ts) FROM events
WHERE event_type IS NULL OR event_type NOT IN ('click', 'view')""",
)
def compare_paths(t):
    streamed = F.coalesce(F.col("event_type").isin("click", "view"), F.lit(False))
    a, b = t.events.filter(streamed), t.events.filter(~streamed)
    return path_stats({"stream": a, "manual": b}, "user_id", "ts")


@query("flow_check", "ST-14", "SELECT count(*) AS records, max(ts) AS newest, count(*) > 0 AS flowing FROM events")
def flow_check(t):
    return C.flow_check(t.events, "ts")


@query(
    "batch_completeness",
    "ST-15",
    """
WITH b AS (SELECT o_custkey AS batch, count(*) AS expected_count,
                  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) AS BIGINT) AS actual_count FROM orders GROUP BY 1)
SELECT batch, expected_count, actual_count,
       CASE WHEN actual_count = expected_count THEN 'success' WHEN actual_count > 0 THEN 'partial' ELSE 'failed' END
         AS validation_status, round_to(actual_count * 100.0 / expected_count, 4) AS success_rate FROM b""",
)
def batch_completeness(t):
    b = t.orders.groupBy(F.col("o_custkey").alias("batch")).agg(
        F.count(F.lit(1)).alias("expected_count"), F.count_if(F.col("o_orderstatus") != "F").alias("actual_count")
    )
    done = C.completeness(b, "expected_count", "actual_count")
    return done.withColumn("success_rate", round_to(F.col("success_rate").cast("double"), 4))


@query(
    "load_report",
    "ST-16 IN-01",
    f"""
SELECT 'total' AS section, '' AS item, count(*) AS records, round_to(avg(p_retailprice), 2) AS avg_price FROM part
UNION ALL SELECT 'shard', CAST({stable_sql("p_partkey")} % 4 AS VARCHAR), count(*), round_to(avg(p_retailprice), 2) FROM part GROUP BY 2
UNION ALL SELECT 'category', p_brand, count(*), round_to(avg(p_retailprice), 2) FROM part GROUP BY 2
UNION ALL SELECT 'partition', p_type, count(*), round_to(avg(p_retailprice), 2) FROM part GROUP BY 2""",
)
def load_report(t):
    """The whole report; an empty load fails."""
    report = C.validate_load(t.part, "p_brand", "p_retailprice", 4, F.col("p_type"), "p_partkey")
    return C.require_loaded(report).withColumn("avg_price", round_to("avg_price", 2))


@query(
    "stream_hourly",
    "ST-17",
    """
SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round_to(sum(value), 2) AS total FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1, 2""",
)
def stream_hourly(t):
    """Hours that can no longer change; the last ones stay open."""
    decoded = _typed(K.decode(_stream(t), BODY).filter("_corrupt IS NULL"))
    hours = ingest.hourly(
        decoded,
        "event_time",
        ["event_type"],
        {"n": F.count(F.lit(1)), "total": F.sum("value")},
    )
    path = new_path(t.spark, "hours")
    ingest.to_table(hours.withColumn("day", F.date_format("hour", "yyyy-MM-dd")), path, new_path(t.spark, "cp"), ["day"])
    stored = t.spark.read.schema(hours.schema).parquet(path)
    return stored.select("hour", "event_type", "n", round_to("total", 2).alias("total"))


_HELD_BACK = "event_id % 50 = 0"
_HOURS_SQL = f"""
WITH first AS (SELECT max(ts) AS newest FROM events WHERE NOT coalesce({_HELD_BACK}, FALSE)), marked AS (
  SELECT e.*, date_trunc('hour', ts) AS hour,
         coalesce({_HELD_BACK}, FALSE) AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= first.newest - INTERVAL 1 HOUR AS late
  FROM events e, first)"""


def _hours_with_late_rows(t):
    """Events in three micro-batches: the earlier half, the later half, and some that were held back."""
    half = t.events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5).alias("m")).first()["m"] or 0
    held = F.coalesce(F.expr(_HELD_BACK), F.lit(False))
    early = F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")) <= half, F.lit(True))
    rows, path = t.events.select("event_id", "event_type", "ts", "value"), new_path(t.spark, "arrivals")
    for part in (rows.filter(~held & early), rows.filter(~held & ~early), rows.filter(held)):
        part.coalesce(1).write.mode("append").parquet(path)
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    hours = HourlySums(t.spark, new_path(t.spark, "hours"), "ts", ["event_type"], {"total": F.col("value")})
    ingest.run_available(stream, new_path(t.spark, "cp"), hours.add)
    return hours


@query(
    "stream_hourly_on_time",
    "ST-17",
    f"""{_HOURS_SQL}
SELECT hour, event_type, count(*) AS n, round_to(sum(value), 2) AS total FROM marked
WHERE NOT late AND hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1, 2""",
)
def stream_hourly_on_time(t):
    """Closed hours of several micro-batches, without the rows that came after their hour was closed."""
    hours = _hours_with_late_rows(t).closed_hours()
    return hours.select("hour", "event_type", "n", round_to("total", 2).alias("total"))


@query("stream_hourly_late", "ST-17", f"{_HOURS_SQL} SELECT event_id, ts, value FROM marked WHERE late")
def stream_hourly_late(t):
    """The rows that came too late are kept aside."""
    return _hours_with_late_rows(t).late_rows().select("event_id", "ts", "value")


@query(
    "stream_enriched_pinned",
    "ST-18",
    """
SELECT event_id, coalesce(c_mktsegment, '') AS c_mktsegment FROM events LEFT JOIN
  (SELECT * FROM customer WHERE c_acctbal > 0) c ON user_id = c_custkey""",
)
def stream_enriched_pinned(t):
    """The dictionary changes after the stream has run; a replay of its batches gives the rows it gave before."""
    kept = t.customer.filter("c_acctbal > 0").select(F.concat(F.lit("L"), F.col("c_custkey").cast("string")).alias("k"), "c_mktsegment")
    now = {"dictionary": kept}
    pinned = PinnedDictionary(t.spark, new_path(t.spark, "pinned"), lambda: now["dictionary"], least=0, most=0)
    topic = _topic(t)

    def enrich(df, d):
        rows = K.decode(df, BODY).select("event_id", "location_key")
        return lookup(rows, d, "location_key", "k", {"c_mktsegment": ""}).select("event_id", "c_mktsegment")

    out = new_path(t.spark, "enriched")
    for _ in range(2):  # a new checkpoint runs the same batches again
        ingest.run_available(_stream(t, topic), new_path(t.spark, "cp"), ingest.batch_writer(out, transform=pinned.enriching(enrich)))
        now["dictionary"] = kept.withColumn("c_mktsegment", F.lit("changed"))
    return t.spark.read.parquet(out).select("event_id", "c_mktsegment")


@query(
    "stream_enriched",
    "ST-18 J09",
    """
SELECT event_id, coalesce(c_mktsegment, '') AS c_mktsegment FROM events LEFT JOIN
  (SELECT * FROM customer WHERE c_acctbal > 0) c ON user_id = c_custkey""",
)
def stream_enriched(t):
    """Every micro-batch reads the dictionary anew."""
    out = new_path(t.spark, "enriched")

    def dictionary():
        d = t.customer.filter("c_acctbal > 0")
        return d.select(F.concat(F.lit("L"), F.col("c_custkey").cast("string")).alias("k"), "c_mktsegment")

    def enrich(df, d):
        rows = K.decode(df, BODY).select("event_id", "location_key")
        return lookup(rows, d, "location_key", "k", {"c_mktsegment": ""}).select("event_id", "c_mktsegment")

    ingest.run_available(
        _stream(t), new_path(t.spark, "cp"), ingest.batch_writer(out, transform=ingest.refreshed(dictionary, enrich))
    )
    return t.spark.read.parquet(out).select("event_id", "c_mktsegment")


@query(
    "stream_logs",
    "ST-19 MV-13 MU-12",
    f"""
WITH {LOGS}
SELECT timestamp, level, logger_name, message, thread_id, replica_name, CAST(1 AS INTEGER) AS shard FROM logs
WHERE timestamp >= TIMESTAMP '2024-01-24'""",
)
def stream_logs(t):
    """Log rows pass through, gain arrival columns, and rows over seven days old expire."""
    incoming = new_path(t.spark, "logs-in")
    logs(t).select("timestamp", "level", "logger_name", "message", "thread_id", "replica_name").write.parquet(incoming)
    schema = t.spark.read.parquet(incoming).schema
    passed = ingest.ingestion_columns(t.spark.readStream.schema(schema).parquet(incoming), as_of=_NOW)
    passed = passed.withColumn("day", (F.year("timestamp") * 10000 + F.month("timestamp") * 100 + F.dayofmonth("timestamp")))
    path = new_path(t.spark, "logs")

    def store(df, batch):
        W.write_partitioned(df.withColumn("batch", F.lit(batch)), path, ["day", "batch"], "replace_partitions")

    ingest.run_available(passed, new_path(t.spark, "cp"), store)
    whole = T.StructType(
        [f for f in passed.schema if f.name != "day"]
        + [T.StructField("day", T.IntegerType()), T.StructField("batch", T.LongType())]
    )
    folder = W.Folder(t.spark, path, whole, ("day", "batch"))
    W.expire(folder, "timestamp", 7, dt.datetime(2024, 1, 31))
    return folder.read().select(
        "timestamp", "level", "logger_name", "message", "thread_id", "replica_name", F.col("replica_shard").alias("shard")
    )


@query(
    "stream_transform_view",
    "MV-07",
    """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'view_page' ELSE event_type END AS activity_type FROM events""",
)
def stream_transform_view(t):
    """Rows changed on the way to a second table, once per insert even when a batch is replayed."""
    out = new_path(t.spark, "transformed")

    def change(df, _):
        rows = K.decode(df, BODY)
        kind = F.when(F.col("event_type") == "purchase", "view_page").otherwise(F.col("event_type"))
        return rows.select("event_id", kind.alias("activity_type"))

    ingest.run_available(_stream(t), new_path(t.spark, "cp"), ingest.batch_writer(out, transform=change))
    return t.spark.read.parquet(out).select("event_id", "activity_type")


@query(
    "stream_rollup",
    "MV-01 MV-03",
    """
SELECT 'L' || user_id AS location_key, count(*) AS rows, CAST(sum(floor(value)) AS BIGINT) AS confirmed FROM events GROUP BY 1""",
)
def stream_rollup(t):
    """A rollup fed by a stream: each micro-batch writes its state rows."""
    rollup = R.Rollup(
        t.spark,
        new_path(t.spark, "stream-rollup"),
        "ym",
        ["location_key"],
        {"rows": F.lit(1).cast("long"), "confirmed": F.col("new_confirmed")},
    )

    def add(df, batch):
        rollup.add_batch(_typed(K.decode(df, BODY)), str(batch))

    source = K.read_stream(t.spark, "parquet", K.TOPIC_SCHEMA, path=_topic(t), maxFilesPerTrigger=4)
    ingest.run_available(source, new_path(t.spark, "cp"), add)
    return rollup.read()


@query(
    "minute_counts",
    "FN-11 FN-12",
    """
SELECT date_trunc('minute', ts) AS minute, count(*) AS n, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1""",
)
def minute_counts(t):
    return t.events.groupBy(start_of("minute", "ts").alias("minute")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_type").alias("kinds")
    )


@query(
    "record_digests_unique",
    "FN-28",
    "SELECT count(*) AS records, count(*) AS digests FROM events",
)
def record_digests_unique(t):
    d = t.events.select(row_digest("event_id", "user_id", "event_type", "props").alias("h"))
    return d.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("h").alias("digests"))
