"""Projections, filters, scalar functions and user-defined functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from brookmill.functions.types import round_to

from brookmill.functions import business as B
from brookmill.functions import dates as D
from brookmill.functions import hashing as H
from brookmill.functions import text as X
from brookmill.functions import types as Y
from brookmill.operators.filters import between_days, run_template, where_in
from brookmill.plans.registry import query
from brookmill.plans.views import AS_OF, AS_OF_SQL, EVENT_K, event_k

# ---- projections and filters ------------------------------------------------


@query("pf_projection", "PF-01", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def pf_projection(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "pf_alias_reuse",
    "PF-02",
    """
SELECT o_orderkey, round_to(o_totalprice * 2, 2) AS doubled, round_to(o_totalprice * 2, 2) + 1 AS doubled_plus_one FROM orders""",
)
def pf_alias_reuse(t):
    return t.orders.select(
        "o_orderkey", round_to(F.col("o_totalprice") * 2, 2).alias("doubled")
    ).withColumn("doubled_plus_one", F.col("doubled") + 1)


@query(
    "pf_comparison",
    "PF-03",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_quantity > 20 AND l_discount <= 0.05 AND l_returnflag = 'R'""",
)
def pf_comparison(t):
    return t.lineitem.filter("l_quantity > 20 AND l_discount <= 0.05 AND l_returnflag = 'R'").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query(
    "pf_early_filter",
    "PF-04",
    """
SELECT o_orderkey, c_name FROM customer JOIN orders ON c_custkey = o_custkey
WHERE c_mktsegment = 'MACHINERY' AND o_totalprice > 100000""",
)
def pf_early_filter(t):
    c = t.customer.filter("c_mktsegment = 'MACHINERY'").select("c_custkey", "c_name")
    o = t.orders.filter("o_totalprice > 100000").select("o_orderkey", "o_custkey")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "c_name")


@query("pf_like", "PF-05", "SELECT doc_id, source FROM documents WHERE text LIKE '%license%'")
def pf_like(t):
    return t.documents.filter(F.col("text").like("%license%")).select("doc_id", "source")


@query("pf_ilike", "PF-06", "SELECT doc_id, source FROM documents WHERE text ILIKE '%LICENSE%'")
def pf_ilike(t):
    return t.documents.filter(F.col("text").ilike("%LICENSE%")).select("doc_id", "source")


@query("pf_between", "PF-07", "SELECT event_id, value FROM events WHERE value BETWEEN 5 AND 150")
def pf_between(t):
    return t.events.filter(F.col("value").between(5, 150)).select("event_id", "value")


@query("pf_in_list", "PF-08", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def pf_in_list(t):
    return t.events.filter(F.col("event_type").isin("click", "view")).select("event_id", "event_type")


@query(
    "pf_is_null",
    "PF-09 SC-18",
    """
SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.lang IS NOT NULL""",
)
def pf_is_null(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left").filter(F.col("lang").isNotNull())
    return Y.with_defaults(joined.select("doc_id", "quality", "toxic"), {"quality": -1, "toxic": 0})


@query(
    "pf_not_empty",
    "PF-10",
    """
SELECT c_custkey, coalesce(o.status, '') AS status FROM customer
LEFT JOIN (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS status FROM orders) o
  ON c_custkey = o_custkey
WHERE coalesce(o.status, '') <> ''""",
)
def pf_not_empty(t):
    o = t.orders.select("o_custkey", F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus")).alias("status"))
    joined = t.customer.join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.filter(X.not_empty("status")).select("c_custkey", "status")


@query("pf_since", "PF-11 FN-14", f"SELECT event_id, ts FROM events WHERE ts >= {AS_OF_SQL} - INTERVAL 36 HOUR")
def pf_since(t):
    return t.events.filter(D.since("ts", AS_OF, hours=36)).select("event_id", "ts")


@query(
    "pf_template",
    "PF-12",
    f"SELECT event_type, count(*) AS n FROM events WHERE ts >= {AS_OF_SQL} - INTERVAL 604800 SECOND AND value > 10 GROUP BY 1",
)
def pf_template(t):
    return run_template(
        t.spark,
        """SELECT event_type, count(*) AS n FROM {events}
           WHERE ts >= :as_of - make_dt_interval(0, 0, 0, :seconds) AND value > :least GROUP BY event_type""",
        {"events": t.events},
        as_of=AS_OF,
        seconds=604800,
        least=10,
    )


@query(
    "pf_case",
    "PF-14",
    """
SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size, count(*) AS n,
       count(CASE WHEN l_discount > 0.05 THEN 1 END) AS discounted
FROM lineitem GROUP BY 1""",
)
def pf_case(t):
    size = Y.band("l_quantity", [(10, "small"), (30, "medium")], "large", closed=False)
    return t.lineitem.groupBy(size.alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("discounted")
    )


@query("pf_distinct", "PF-15", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def pf_distinct(t):
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query(
    "pf_where_in",
    "PF-16",
    "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (1, 3, 5) UNION ALL SELECT c_custkey, c_nationkey FROM customer",
)
def pf_where_in(t):
    c = t.customer.select("c_custkey", "c_nationkey")
    return where_in(c, "c_nationkey", [1, 3, 5]).unionByName(where_in(c, "c_nationkey", []))


@query(
    "pf_between_days",
    "PF-17",
    """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-06-01'
UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'""",
)
def pf_between_days(t):
    o = t.orders.select("o_orderkey", "o_orderdate")
    spring = between_days(o, "o_orderdate", dt.date(1996, 3, 1), dt.date(1996, 5, 31))
    return spring.unionByName(between_days(o, "o_orderdate", first=dt.date(2001, 1, 1)))


@query(
    "pf_month",
    "PF-18",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) * 100 + month(o_orderdate) = 199712",
)
def pf_month(t):
    return t.orders.filter(D.in_month("o_orderdate", 199712)).select("o_orderkey", "o_totalprice")


@query("pf_year", "PF-19", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE year(l_shipdate) = 1995")
def pf_year(t):
    return t.lineitem.filter(D.in_year("l_shipdate", 1995)).select("l_orderkey", "l_linenumber", "l_shipdate")


@query("pf_point_lookup", "PF-21", "SELECT * FROM customer WHERE c_custkey = 77")
def pf_point_lookup(t):
    return t.customer.filter("c_custkey = 77")


# ---- scalar functions -------------------------------------------------------


@query(
    "q_type_functions",
    "PF-02 FN-01 FN-02 FN-03 FN-09 FN-19",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_text, substring(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) AS year_cut,
       substring(strftime(o_orderdate, '%Y-%m-%d'), 6, 2) AS month_cut,
       split_part(strftime(o_orderdate, '%Y-%m-%d'), '-', 1) AS year_part,
       split_part(strftime(o_orderdate, '%Y-%m-%d'), '-', 2) AS month_part,
       CAST(year(o_orderdate) AS INTEGER) AS year_number, CAST(month(o_orderdate) AS INTEGER) AS month_number,
       o_totalprice AS price, round(o_totalprice) AS whole_price, CAST(o_orderkey AS VARCHAR) AS order_text
FROM orders""",
)
def type_functions(t):
    return t.orders.select(
        "o_orderkey", F.to_date("o_orderdate").cast("string").alias("day_text"), "o_orderdate", "o_totalprice"
    ).select(
        "o_orderkey",
        "day_text",
        F.substring("day_text", 1, 4).alias("year_cut"),
        F.substring("day_text", 6, 2).alias("month_cut"),
        X.split_at("day_text", "-", 1).alias("year_part"),
        X.split_at("day_text", "-", 2).alias("month_part"),
        F.year("o_orderdate").alias("year_number"),
        F.month("o_orderdate").alias("month_number"),
        F.col("o_totalprice").alias("price"),
        F.round("o_totalprice").alias("whole_price"),
        F.col("o_orderkey").cast("string").alias("order_text"),
    )


@query(
    "fn_text",
    "FN-02 FN-03 FN-04 FN-06",
    """
SELECT doc_id, lower(substring(source, 1, 3)) AS head, split_part(source, 'c', 2) AS tail, split_part(source, 'c', 9) AS outside,
       concat(lang, '/', source) AS place, ends_with(lower(source), '1') AS ends_in_one, CAST(length(text) AS INTEGER) AS chars
FROM documents""",
)
def fn_text(t):
    return t.documents.select(
        "doc_id",
        F.lower(F.substring("source", 1, 3)).alias("head"),
        X.split_at("source", "c", 2).alias("tail"),
        X.split_at("source", "c", 9).alias("outside"),
        F.concat("lang", F.lit("/"), "source").alias("place"),
        F.endswith(F.lower("source"), F.lit("1")).alias("ends_in_one"),
        F.length("text").alias("chars"),
    )


@query(
    "fn_html_text",
    "FN-07",
    r"""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
         '(?s)<!--.*?-->', ' ', 'g'), '(?is)<script\b[^>]*>.*?</script\s*>', ' ', 'g'),
         '(?is)<style\b[^>]*>.*?</style\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text
FROM pages""",
)
def fn_html_text(t):
    return t.pages.select("page_id", X.html_text("html").alias("text"))


@query(
    "fn_calendar",
    "FN-09 FN-10 FN-11 FN-12 FN-13 FN-15 FN-18",
    """
SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(hour(ts) AS INTEGER) AS h,
       CAST(year(ts) * 100 + month(ts) AS INTEGER) AS yyyymm, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS yyyymmdd,
       strftime(date_trunc('month', ts), '%Y-%m-%d') AS month_start, date_trunc('day', ts) AS day_start,
       date_trunc('hour', ts) AS hour_start, date_trunc('minute', ts) AS minute_start,
       CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) % 90 AS bucket90,
       strftime(ts + INTERVAL 10 DAY, '%Y-%m-%d') AS in_ten_days, ts - INTERVAL 5 HOUR AS five_hours_ago,
       ts + INTERVAL 30 SECOND AS half_minute_on, strftime(ts, '%Y-%m-%d %H:%M:%S') AS spelled
FROM events""",
)
def fn_calendar(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        F.year(ts).alias("y"),
        F.month(ts).alias("m"),
        F.hour(ts).alias("h"),
        D.yyyymm(ts).alias("yyyymm"),
        D.yyyymmdd(ts).alias("yyyymmdd"),
        D.start_of_month(ts).cast("string").alias("month_start"),
        D.start_of("day", ts).alias("day_start"),
        D.start_of("hour", ts).alias("hour_start"),
        D.start_of("minute", ts).alias("minute_start"),
        D.epoch_bucket(ts, 90).alias("bucket90"),
        F.date_add(F.to_date(ts), 10).cast("string").alias("in_ten_days"),
        (ts - F.make_dt_interval(hours=F.lit(5))).alias("five_hours_ago"),
        (ts + F.make_dt_interval(secs=F.lit(30))).alias("half_minute_on"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("spelled"),
    )


@query(
    "fn_numbers",
    "FN-19 FN-20 FN-21 FN-22 FN-23 FN-24 FN-25",
    """
SELECT o_orderkey, round_to(o_totalprice, 1) AS r1, abs(o_totalprice - 250000) AS distance, o_custkey // 7 AS sevens,
       o_custkey % 7 AS rest, round_to(o_totalprice / nullif(o_custkey % 3, 0), 4) AS per_rest,
       coalesce(CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_totalprice END, 0) AS price_or_zero,
       CAST(floor(o_totalprice) AS BIGINT) AS whole, CAST(o_custkey AS DOUBLE) AS key_double, CAST(o_custkey AS VARCHAR) AS key_text,
       CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE NULL END AS INTEGER) AS status_code
FROM orders""",
)
def fn_numbers(t):
    price, key = F.col("o_totalprice"), F.col("o_custkey")
    nan = F.when(key % 3 == 0, F.lit(float("nan"))).otherwise(price)
    return t.orders.select(
        "o_orderkey",
        round_to(price, 1).alias("r1"),
        F.abs(price - 250000).alias("distance"),
        Y.int_div(key, F.lit(7)).alias("sevens"),
        (key % 7).alias("rest"),
        round_to(Y.ratio(price, key % 3), 4).alias("per_rest"),
        Y.nan_to(nan, 0.0).alias("price_or_zero"),
        F.floor(price).cast("long").alias("whole"),
        key.cast("double").alias("key_double"),
        key.cast("string").alias("key_text"),
        Y.enum_code("o_orderstatus", {"F": 1, "O": 2}).alias("status_code"),
    )


@query(
    "fn_arrays",
    "FN-05 FN-31 FN-32 FN-33",
    """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims, round_to(embedding[1], 6) AS first_value, CAST(embedding[len(embedding) + 1] AS DOUBLE) AS outside,
       (['low', 'mid', 'high'])[1 + vec_id % 3] AS picked,
       CAST(len(list_distinct([label, label, label + 1])) AS INTEGER) AS distinct_labels
FROM embeddings""",
)
def fn_arrays(t):
    return t.embeddings.select(
        "vec_id",
        F.size("embedding").alias("dims"),
        round_to(Y.at(F.col("embedding"), 1), 6).alias("first_value"),
        Y.at(F.col("embedding"), F.size("embedding") + 1).cast("double").alias("outside"),
        Y.at(F.array(F.lit("low"), F.lit("mid"), F.lit("high")), 1 + F.col("vec_id") % 3).alias("picked"),
        F.size(F.array_distinct(F.array("label", "label", F.col("label") + 1))).alias("distinct_labels"),
    )


@query(
    "fn_explode_words",
    "FN-33 FN-03",
    r"""
SELECT lang, word, count(*) AS n FROM (
  SELECT lang, unnest(string_split_regex(text, '[ \n]+')) AS word FROM documents) w
WHERE word <> '' GROUP BY 1, 2""",
)
def fn_explode_words(t):
    words = t.documents.select("lang", F.explode(F.split("text", "[ \\n]+")).alias("word"))
    return words.filter("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fn_zip_measures",
    "FN-34 MV-12",
    """
SELECT l_orderkey, l_linenumber, 'Quantity' AS metric_name, l_quantity AS metric_value FROM lineitem WHERE l_quantity > 0
UNION ALL SELECT l_orderkey, l_linenumber, 'Discount', l_discount FROM lineitem WHERE l_discount > 0
UNION ALL SELECT l_orderkey, l_linenumber, 'Tax', l_tax FROM lineitem WHERE l_tax > 0""",
)
def fn_zip_measures(t):
    from brookmill.operators.aggregates import unpivot_measures

    measures = {"Quantity": F.col("l_quantity"), "Discount": F.col("l_discount"), "Tax": F.col("l_tax")}
    long = unpivot_measures(t.lineitem, ["l_orderkey", "l_linenumber"], measures, "metric_name", "metric_value")
    return long.filter("metric_value > 0")


@query(
    "fn_json",
    "FN-35",
    f"""
WITH {EVENT_K}
SELECT event_id, k, '{{"event_id":' || event_id || ',"k":' || k || '}}' AS body FROM event_k""",
)
def fn_json(t):
    return event_k(t).select("event_id", "k", F.to_json(F.struct("event_id", "k")).alias("body"))


@query(
    "fn_parse_any",
    "FN-13 FN-16",
    """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS parsed FROM orders""",
)
def fn_parse_any(t):
    d, p = F.col("o_orderdate"), F.col("o_orderpriority")
    spelled = (
        F.when(p == "1-URGENT", F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(p == "2-HIGH", F.date_format(d, "yyyyMMdd"))
        .when(p == "3-MEDIUM", F.date_format(d, "dd/MM/yyyy"))
        .when(p == "4-NOT SPECIFIED", F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise("not a date")
    )
    return t.orders.select("o_orderkey", D.parse_any(spelled).cast("timestamp_ntz").alias("parsed"))


@query(
    "fn_parse_month_first_or_zero",
    "FN-17",
    """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_orderdate
       ELSE TIMESTAMP '1970-01-01 00:00:00' END AS parsed FROM orders""",
)
def fn_parse_month_first_or_zero(t):
    d, p = F.col("o_orderdate"), F.col("o_orderpriority")
    spelled = (
        F.when(p == "1-URGENT", F.date_format(d, "MM/dd/yyyy"))
        .when(p == "2-HIGH", F.date_format(d, "yyyy-MM-dd"))
        .when(p == "3-MEDIUM", F.date_format(d, "MM/dd/yyyy HH:mm:ss"))
        .when(p == "4-NOT SPECIFIED", F.lit("?"))
    )
    return t.orders.select("o_orderkey", D.parse_month_first_or_zero(spelled).cast("timestamp_ntz").alias("parsed"))


@query(
    "fn_date_or_side_table",
    "FN-37",
    """
SELECT 'read' AS part, count(*) AS n FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'not readable', count(*) FROM orders WHERE o_orderstatus = 'P'""",
)
def fn_date_or_side_table(t):
    from brookmill.streaming.typing import split_unparsed

    text = F.when(F.col("o_orderstatus") == "P", "31-31-31").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = t.orders.select(text.alias("raw")).withColumn("day", F.try_to_date("raw", "yyyy-MM-dd"))
    good, bad = split_unparsed(rows, "raw", "day")
    a = good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("read").alias("part"), "n")
    b = bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("not readable").alias("part"), "n")
    return a.unionByName(b)


_BYTES = "(n_chars * n_chars)"


@query(
    "fn_readable_size",
    "FN-30",
    f"""
SELECT doc_id, CASE WHEN {_BYTES} < 1024 THEN printf('%.2f B', round_to({_BYTES}, 2))
   WHEN {_BYTES} < 1048576 THEN printf('%.2f KiB', round_to({_BYTES} / 1024.0, 2))
   WHEN {_BYTES} < 1073741824 THEN printf('%.2f MiB', round_to({_BYTES} / 1048576.0, 2))
   ELSE printf('%.2f GiB', round_to({_BYTES} / 1073741824.0, 2)) END AS size FROM documents""",
)
def fn_readable_size(t):
    return t.documents.select("doc_id", X.readable_size(F.col("n_chars") * F.col("n_chars")).alias("size"))


@query(
    "fn_row_digest",
    "FN-28",
    """
SELECT event_id, sha256('event_id=' || length(CAST(event_id AS VARCHAR)) || ':' || event_id || '|event_type=' ||
       length(event_type) || ':' || event_type || '|user_id=' || length(CAST(user_id AS VARCHAR)) || ':' || user_id) AS record_hash
FROM events""",
)
def fn_row_digest(t):
    return t.events.select("event_id", H.row_digest("event_id", "user_id", "event_type").alias("record_hash"))


@query("fn_repeatable_text", "FN-08", "SELECT o_orderkey, substring(md5(CAST(o_orderkey AS VARCHAR)), 1, 10) AS s FROM orders")
def fn_repeatable_text(t):
    return t.orders.select("o_orderkey", H.repeatable_text("o_orderkey", 10).alias("s"))


@query(
    "fn_shards",
    "FN-27 FN-26",
    f"""
SELECT CAST({H.stable_sql("o_orderkey")} % 8 AS INTEGER) AS shard, count(*) AS n,
       CAST(sum({H.stable_sql("7", "o_orderkey")} % 1000) AS BIGINT) AS drawn, TRUE AS hash_in_range, TRUE AS unit_in_range
FROM orders GROUP BY 1""",
)
def fn_shards(t):
    """Rows per shard by a hash every engine has, the sum of repeatable draws, and the ranges of the faster Spark hash."""
    shard, unit = H.shard_of(8, "o_orderkey"), H.repeatable_unit(7, "o_orderkey")
    return t.orders.groupBy((H.stable_number("o_orderkey") % 8).cast("int").alias("shard")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(H.stable_number(F.lit(7), "o_orderkey") % 1000).alias("drawn"),
        F.bool_and((shard >= 0) & (shard < 8)).alias("hash_in_range"),
        F.bool_and((unit >= 0) & (unit < 1)).alias("unit_in_range"),
    )


@query("fn_uuid", "FN-29", "SELECT count(*) AS n, count(*) AS distinct_ids, TRUE AS well_formed FROM orders")
def fn_uuid(t):
    """A new identifier per row: as many as rows, all different, all of the usual form."""
    form = F.regexp_like("query_id", F.lit("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"))
    return t.orders.select(H.new_uuid().alias("query_id")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("query_id").alias("distinct_ids"), F.bool_and(form).alias("well_formed")
    )


@query(
    "fn_placement",
    "FN-36",
    "\nUNION ALL ".join(f"SELECT '{n}' AS source, count(*) AS n, TRUE AS placed FROM {n}" for n in ("lineitem", "orders")),
)
def fn_placement(t):
    """Where rows are: per file and task, summed per table."""
    placed = [
        df.select(F.lit(name).alias("source"), F.col("_metadata.file_path").alias("file"), F.spark_partition_id().alias("task"))
        for name, df in (("lineitem", t.lineitem), ("orders", t.orders))
    ]
    by_place = placed[0].unionByName(placed[1]).groupBy("source", "file", "task").agg(F.count(F.lit(1)).alias("n"))
    known = F.bool_and(F.col("file").isNotNull() & (F.col("task") >= 0))
    return by_place.groupBy("source").agg(F.sum("n").alias("n"), known.alias("placed"))


# ---- user-defined functions -------------------------------------------------


@query(
    "q_udf_simple",
    "UD-01 UD-02 UD-03",
    f"""
SELECT l_orderkey, l_linenumber, l_discount * l_quantity * 100 AS total_transaction_cost,
       {B.simple_sql("l_discount * l_quantity * 100")} AS transaction_category
FROM lineitem""",
)
def udf_simple(t):
    cost = B.total_cost_simple(F.col("l_discount") * F.col("l_quantity"), F.lit(100))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        cost.alias("total_transaction_cost"),
        B.classify_transaction_simple(cost).alias("transaction_category"),
    )


@query(
    "q_udf_total",
    "UD-04",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice * l_quantity, 2) AS total_price FROM lineitem",
)
def udf_total(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", B.total_cost("l_extendedprice", "l_quantity").alias("total_price"))


_CLASSIFY_SQL = f"""
SELECT l_orderkey, l_extendedprice / 100 AS price, l_linenumber AS quantity, 500 + l_partkey % 101 AS product_id,
       100 + l_suppkey % 101 AS user_id,
       {B.class_sql("l_extendedprice / 100 * l_linenumber", "500 + l_partkey % 101", "100 + l_suppkey % 101")} AS transaction_category
FROM lineitem"""


def _purchases(t):
    return t.lineitem.select(
        "l_orderkey",
        (F.col("l_extendedprice") / 100).alias("price"),
        F.col("l_linenumber").alias("quantity"),
        (500 + F.col("l_partkey") % 101).alias("product_id"),
        (100 + F.col("l_suppkey") % 101).alias("user_id"),
    )


@query("q_udf_classify", "UD-05", _CLASSIFY_SQL)
def udf_classify(t):
    return _purchases(t).withColumn(
        "transaction_category", B.classify_transaction("price", "quantity", "product_id", "user_id")
    )


@query("udf_classify_batch", "UD-05", _CLASSIFY_SQL)
def udf_classify_batch(t):
    """All rows through the function as ``spark.sql`` callers name it; its body is inlined."""
    B.register_sql_functions(t.spark)
    called = "classify_transaction(CAST(price AS DOUBLE), CAST(quantity AS DOUBLE), product_id, user_id) AS transaction_category"
    return _purchases(t).selectExpr("*", called)


_FRAUD_SQL = f"""
SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_partkey AS product_id,
       {B.fraud_sql("l_extendedprice", "l_partkey", "isodow(l_shipdate) >= 6")} AS fraud_status FROM lineitem"""


@query("q_udf_fraud", "UD-06", _FRAUD_SQL)
def udf_fraud(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        F.col("l_partkey").alias("product_id"),
        B.detect_fraud("l_extendedprice", "l_partkey", "l_shipdate").alias("fraud_status"),
    )


@query("udf_labelled_value", "UD-07", "SELECT o_orderkey, 'Value ' || CAST(o_orderkey AS VARCHAR) AS v FROM orders")
def udf_labelled_value(t):
    return t.orders.select("o_orderkey", B.labelled_value("o_orderkey").alias("v"))


@query(
    "udf_missing_arguments",
    "UD-08",
    f"""
SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL
       THEN {B.class_sql("d.n_chars * (l.quality + 1)", "d.doc_id", "d.doc_id")} END AS category
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def udf_missing_arguments(t):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return rows.select(
        "doc_id", B.classify_transaction("n_chars", F.col("quality") + 1, "doc_id", "doc_id").alias("category")
    )


@query(
    "udf_in_sql",
    "UD-01 UD-02 UD-04 UD-05 UD-06 UD-07",
    f"""
SELECT l_orderkey, l_linenumber, round(l_extendedprice * l_quantity, 2) AS total, 'Value ' || l_partkey AS v,
       {B.fraud_sql("l_extendedprice", "l_partkey", "isodow(l_shipdate) >= 6")} AS fraud,
       {B.simple_sql("l_extendedprice * 0.001")} AS category,
       CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS month
FROM lineitem""",
)
def udf_in_sql(t):
    B.register_sql_functions(t.spark)
    return t.spark.sql(
        """SELECT l_orderkey, l_linenumber, total_cost(l_extendedprice, l_quantity) AS total, labelled_value(l_partkey) AS v,
                  detect_fraud(l_extendedprice, l_partkey, CAST(l_shipdate AS DATE)) AS fraud,
                  classify_transaction_simple(total_cost_simple(l_extendedprice, 0.001D)) AS category,
                  yyyymm(l_shipdate) AS month
           FROM {lineitem}""",
        lineitem=t.lineitem,
    )
