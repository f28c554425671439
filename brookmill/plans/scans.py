"""Sources and sinks: the shared tables written in another form and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmill.functions.types import or_default, round_to
from brookmill.operators import tables as W
from brookmill.plans.registry import query
from brookmill.plans.views import CASES, EVENT_K, cases, event_k
from brookmill.scratch import new_path
from brookmill.sources import files as S
from brookmill.sources.generate import numbers, values
from brookmill.sources.external import append_external, read_external
from brookmill.sources.tables import union_matching
from brookmill.sources.topics import message_key, to_messages


@query("scan_csv", "SC-01 SK-09", "SELECT * FROM orders")
def scan_csv(t):
    folder = new_path(t.spark, "csv")
    S.write_csv(t.orders, f"{folder}/OrderFacts.csv")
    return S.read_csv(t.spark, f"{folder}/OrderFacts.csv", t.orders.schema)


def _single_csv(t, df, path):
    """One CSV file of this very name, as an export from elsewhere would bring it."""
    folder = new_path(t.spark, "single")
    S.write_csv(df.coalesce(1), folder)
    jvm = t.spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(folder).getFileSystem(t.spark._jsc.hadoopConfiguration())
    written = next(f.getPath() for f in fs.listStatus(jvm.Path(folder)) if f.getPath().getName().endswith(".csv"))
    fs.mkdirs(jvm.Path(path).getParent())
    fs.rename(written, jvm.Path(path))


@query(
    "scan_folder_tables",
    "SC-01",
    """
SELECT 'nation_list' AS "table", n_nationkey AS id, n_name AS name FROM nation
UNION ALL SELECT 'region', r_regionkey, r_name FROM region""",
)
def scan_folder_tables(t):
    """A folder of exports becomes one table per file name; two files of one name make one table."""
    folder = new_path(t.spark, "exports")
    _single_csv(t, t.nation, f"{folder}/a/NationList.csv")
    _single_csv(t, t.region.filter("r_regionkey < 2"), f"{folder}/a/Region.csv")
    _single_csv(t, t.region.filter("NOT coalesce(r_regionkey < 2, FALSE)"), f"{folder}/b/Region.csv")
    found = S.read_csv_tables(t.spark, folder, {"nation_list": t.nation.schema, "region": t.region.schema})
    shown = [
        found[name].select(F.lit(name).alias("table"), F.col(key).alias("id"), F.col(label).alias("name"))
        for name, key, label in (("nation_list", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name"))
    ]
    return shown[0].unionByName(shown[1])


@query("scan_late_files", "SC-16", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_late_files(t):
    """Files are taken two at a time by a ledger. Some arrive late with an older time than files taken before; they are
    taken too, and a run that failed is repeated with its files."""
    folder, late, out = (new_path(t.spark, name) for name in ("arrivals", "late-arrivals", "arrived"))
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    behind = F.coalesce(F.col("o_orderkey") % 3 == 0, F.lit(False))
    S.write_csv(rows.filter(behind).repartition(2), late)
    S.write_csv(rows.filter(~behind).repartition(3), folder)
    ledger = S.FileLedger(t.spark, new_path(t.spark, "ledger"))

    def load(run: str):
        return lambda paths: S.read_csv(t.spark, paths, rows.schema).write.mode("overwrite").parquet(f"{out}/run={run}")

    def fail(paths):
        raise OSError("the first attempt fails")

    try:
        ledger.take("0", folder, ".csv", fail, limit=2)
    except OSError:
        ledger.take("0", folder, ".csv", load("0"), limit=2)
    W.move_into(t.spark, late, folder)
    run = 1
    while ledger.take(str(run), folder, ".csv", load(str(run)), limit=2):
        run += 1
    return t.spark.read.schema(rows.schema).parquet(out).select(*rows.columns)


@query("scan_new_files", "SC-16", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_new_files(t):
    """Files are taken two at a time by the mark (time, path) until none is left; every row comes once."""
    folder = new_path(t.spark, "arrivals")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    S.write_csv(rows.repartition(5, "o_orderkey"), folder)
    out, mark = None, None
    while mark_next := S.last_file(found := S.new_files(t.spark, folder, ".csv", after=mark, limit=2)):
        part = S.read_csv(t.spark, [r["path"] for r in found.collect()], rows.schema)
        out = part if out is None else out.unionByName(part)
        mark = mark_next
    return out


@query(
    "scan_daily_cases",
    "SC-03 PF-08 FN-24",
    f"""
WITH {CASES}
SELECT strftime(date, '%Y-%m-%d') AS date, location_key,
       CASE WHEN new_confirmed > 100 THEN 0 ELSE new_confirmed END AS new_confirmed
FROM cases WHERE date > DATE '2024-01-10' AND location_key IN ('L1', 'L2', 'L3', 'L5', 'L8', 'L13')""",
)
def scan_daily_cases(t):
    folder = new_path(t.spark, "cases")
    few = F.when(F.col("new_confirmed") > 100, None).otherwise(F.col("new_confirmed"))
    S.write_csv(cases(t).select("date", "location_key", few.alias("new_confirmed")), folder)
    raw = S.read_csv(t.spark, folder, "date date, location_key string, new_confirmed long")
    return S.read_daily_cases(
        raw, ["new_confirmed"], after=dt.date(2024, 1, 10), places=["L1", "L2", "L3", "L5", "L8", "L13"]
    )


_SENSOR_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.IntegerType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("P1", T.DoubleType()),
        T.StructField("P2", T.DoubleType()),
    ]
)


@query(
    "scan_sensor_files",
    "SC-04",
    f"""
WITH {EVENT_K}
SELECT CAST(user_id AS INTEGER) AS sensor_id, event_type AS sensor_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
       CASE WHEN event_type IN ('click', 'view') THEN CAST(k AS DOUBLE) ELSE 0.0 END AS P1, value AS P2 FROM event_k""",
)
def scan_sensor_files(t):
    rows = event_k(t).select(
        F.col("user_id").cast("int").alias("sensor_id"),
        F.col("event_type").alias("sensor_type"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("k").cast("double").alias("P1"),
        F.col("value").alias("P2"),
    )
    folder = new_path(t.spark, "sensors")
    S.write_csv(rows.filter("sensor_type IN ('click', 'view')"), f"{folder}/wide", sep=";")
    S.write_csv(rows.filter("sensor_type NOT IN ('click', 'view')").drop("P1"), f"{folder}/narrow", sep=";")
    groups = S.group_by_header(t.spark, folder, _SENSOR_SCHEMA.fieldNames())
    return S.read_sensor_files(t.spark, groups, _SENSOR_SCHEMA, ["timestamp", "sensor_id"])


@query("scan_tsv_gz", "SC-05", "SELECT * FROM part")
def scan_tsv_gz(t):
    folder = new_path(t.spark, "tsv")
    S.write_csv(t.part, folder, sep="\t", compression="gzip")
    return S.read_tsv(t.spark, folder, t.part.schema)


@query("scan_numbered_files", "SC-06", "SELECT * FROM orders")
def scan_numbered_files(t):
    folder = new_path(t.spark, "trips")
    for i in range(3):
        part = t.orders.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == i)
        S.write_csv(part, f"{folder}/trips_{i}.gz", sep="\t", compression="gzip")
    return S.read_tsv(t.spark, S.numbered(f"{folder}/trips_{{0..2}}.gz"), t.orders.schema)


@query(
    "scan_json_nested",
    "SC-07 SC-18 FN-33",
    """
SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE lang END AS lang, CAST(count(*) AS BIGINT) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars
FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents) d GROUP BY 1, 2""",
)
def scan_json_nested(t):
    line = lambda x: F.struct(x.alias("content"), F.length(x).alias("size"))
    rows = t.documents.select(
        "doc_id",
        F.when(F.col("lang") != "en", F.col("lang")).alias("lang"),
        F.transform(F.split("text", "\n"), line).alias("rich_metadata"),
    )
    folder = new_path(t.spark, "json")
    S.write_json(rows, folder)
    read = S.read_json_lines(t.spark, f"{folder}/*.json", rows.schema, {"lang": ""})
    exploded = read.select("doc_id", "lang", F.explode("rich_metadata").alias("m"))
    return exploded.groupBy("doc_id", "lang").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("m.size").cast("long").alias("chars")
    )


@query(
    "scan_number_range",
    "SC-10",
    """
SELECT n AS number FROM (SELECT unnest(generate_series(0, (SELECT max(l_orderkey) FROM lineitem))) AS n) g
WHERE n NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def scan_number_range(t):
    """Order numbers that no line item uses, out of the full range."""
    last = t.lineitem.agg(F.max("l_orderkey").alias("m")).first()["m"]
    used = t.lineitem.select(F.col("l_orderkey").alias("number")).distinct()
    return numbers(t.spark, last + 1).join(used, "number", "left_anti")


@query(
    "scan_values",
    "SC-11",
    """
SELECT v.label, count(*) AS n FROM orders JOIN (VALUES ('1-URGENT', 'now'), ('5-LOW', 'later')) v(priority, label)
ON o_orderpriority = v.priority GROUP BY 1""",
)
def scan_values(t):
    labels = values(t.spark, [("1-URGENT", "now"), ("5-LOW", "later")], "priority string, label string")
    return (
        t.orders.join(labels, F.col("o_orderpriority") == F.col("priority"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "scan_table_union",
    "SC-12",
    """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier""",
)
def scan_table_union(t):
    tables = {
        "party_customer": t.customer.select(
            F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
        ),
        "party_supplier": t.supplier.select(
            F.col("s_suppkey").alias("key"),
            F.col("s_name").alias("name"),
            F.col("s_acctbal").alias("balance"),
            F.lit("supplier").alias("segment"),
        ),
        "goods": t.part.select(F.col("p_partkey").alias("key")),
    }
    return union_matching(tables, "^party_")


@query(
    "sink_append",
    "SK-01",
    "SELECT * FROM orders",
)
def sink_append(t):
    path = new_path(t.spark, "append")
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    t.orders.filter(finished).write.mode("append").parquet(path)
    t.orders.filter(~finished).write.mode("append").parquet(path)
    return t.spark.read.schema(t.orders.schema).parquet(path)


@query(
    "sink_partitioned_month",
    "SK-02 PF-18",
    """
SELECT l_orderkey, l_linenumber, l_shipdate, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ym
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'""",
)
def sink_partitioned_month(t):
    """Written by month; the read names the month column, so other folders are never listed."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate", (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("ym")
    )
    path = new_path(t.spark, "by-month")
    W.write_partitioned(rows, path, ["ym"])
    return t.spark.read.schema(rows.schema).parquet(path).filter(F.col("ym").between(199601, 199612))


@query("sink_clustered", "SK-03", "SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' AND l_shipdate < TIMESTAMP '1999-03-01'")
def sink_clustered(t):
    from brookmill.functions.dates import in_range

    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    path = new_path(t.spark, "clustered")
    W.write_clustered(rows, path, ["l_shipdate"], files=8)
    stored = t.spark.read.schema(rows.schema).parquet(path)
    return stored.filter(in_range("l_shipdate", dt.date(1999, 1, 1), dt.date(1999, 3, 1)))


@query(
    "sink_partition_guard",
    "SK-04",
    """
SELECT 'l_returnflag' AS key, count(DISTINCT l_returnflag) <= 100 AS written, count(*) AS total_rows FROM lineitem
UNION ALL SELECT 'l_orderkey', count(DISTINCT l_orderkey) <= 100, CASE WHEN count(DISTINCT l_orderkey) <= 100 THEN count(*) ELSE 0 END
FROM lineitem""",
)
def sink_partition_guard(t):
    """A partitioned write by two keys: the guard lets one pass and refuses the other before anything is written."""
    out = []
    rows = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber")
    for key in ("l_returnflag", "l_orderkey"):
        path = new_path(t.spark, "guarded")
        try:
            W.require_few_partitions(rows, [key], limit=100)
        except ValueError:
            out.append((key, False, 0))
            continue
        W.write_partitioned(rows, path, [key])
        out.append((key, True, t.spark.read.schema(rows.schema).parquet(path).count()))
    return t.spark.createDataFrame(out, "key string, written boolean, total_rows long")


@query(
    "sink_table_as_select",
    "SK-05",
    """
SELECT o_orderkey, c_name, o_totalprice, CAST(count(*) AS BIGINT) AS lines, round_to(sum(l_extendedprice), 2) AS amount
FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
)
def sink_table_as_select(t):
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"),
        round_to(F.sum("l_extendedprice"), 2).alias("amount"),
    )
    mart = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("o_orderkey", "c_name", "o_totalprice", "lines", "amount")
    )
    return W.create_as(mart, new_path(t.spark, "mart"))


@query("sink_external_append", "SK-08", "SELECT o_orderkey, o_totalprice FROM orders")
def sink_external_append(t):
    """Two commits to an external table, each of them once, and the table read back."""
    path = new_path(t.spark, "external")
    rows = t.orders.select("o_orderkey", "o_totalprice")
    odd = F.coalesce(F.col("o_orderkey") % 2 == 1, F.lit(False))
    append_external(rows.filter(odd), path, "orders")
    append_external(rows.filter(~odd), path, "orders")
    return read_external(t.spark, path, "orders")


@query("sink_json_rows", "SK-10", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def sink_json_rows(t):
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    path = new_path(t.spark, "json-rows")
    S.write_json(rows, path)
    return t.spark.read.schema(rows.schema).json(path)


@query("sink_chunks", "SK-11", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def sink_chunks(t):
    """Loaded in four runs by key hash, one of them twice."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    path = new_path(t.spark, "chunks")
    W.write_chunks(rows, path, "o_orderkey", 4)
    W.write_chunks(rows, path, "o_orderkey", 4, only=[2])
    return t.spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@query(
    "sink_message_keys",
    "SK-12 FN-35",
    """
SELECT user_id || '_' || replace(strftime(ts, '%Y-%m-%d %H:%M:%S'), ' ', '_') AS key,
       '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS value FROM events""",
)
def sink_message_keys(t):
    key = message_key(F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return to_messages(t.events, key, ["event_id", "event_type"])


@query(
    "null_as_default",
    "SC-18 FN-24",
    """
SELECT d.doc_id, coalesce(l.quality, 0) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def null_as_default(t):
    joined = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return joined.select("doc_id", or_default("quality", 0).alias("quality"))
