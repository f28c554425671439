"""Join queries: genres, roles, dictionary lookups, star."""

from __future__ import annotations

from pyspark.sql import functions as F

from brookmill.functions.types import round_to

from brookmill.functions.dates import in_year
from brookmill.functions.hashing import stable_sql
from brookmill.operators.aggregates import collect_parts, part_sql
from brookmill.operators.joins import (
    left_distinct,
    left_where_empty,
    lookup,
    product_top,
    sample_rows,
    star,
    with_rows,
    without_match,
)
from brookmill.operators.prefix import running_sum
from brookmill.operators.tables import create_as
from brookmill.plans.registry import query
from brookmill.scratch import cut, new_path
from brookmill.sources.generate import spread_days


def _movies(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("movie"))


@query(
    "q_genres_flat",
    "J02 FN-32 FN-33 AG-11",
    """
WITH g AS (SELECT c_custkey AS id, c_name AS movie, list_distinct(list(coalesce(event_type, ''))) AS genres
           FROM customer LEFT JOIN events ON c_custkey = user_id GROUP BY ALL)
SELECT movie, unnest(genres) AS genre FROM g""",
)
def genres_flat(t):
    flat = left_distinct(_movies(t), t.events, "id", "user_id", "event_type")
    return flat.select("movie", F.col("event_type").alias("genre")).orderBy("movie", "genre")


@query(
    "q_no_genre",
    "J03 PF-10",
    """
SELECT c_name AS movie FROM customer
LEFT JOIN (SELECT user_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS genre FROM events) g
  ON c_custkey = user_id
WHERE coalesce(genre, '') = ''""",
)
def no_genre(t):
    genres = t.events.select(
        "user_id", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("genre")
    )
    return left_where_empty(_movies(t), genres, "id", "user_id", "genre").select("movie").orderBy("movie")


@query(
    "q_anti",
    "J04",
    """
SELECT c_name AS movie FROM customer
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
)
def anti(t):
    return without_match(_movies(t), t.events, "id", "user_id").select("movie").orderBy("movie")


@query(
    "q_cross",
    "J05",
    """
SELECT c_name AS movie, p_name AS genre FROM customer, part ORDER BY movie, genre LIMIT 20""",
)
def cross(t):
    return product_top(
        t.customer.select(F.col("c_name").alias("movie")),
        t.part.select(F.col("p_name").alias("genre")),
        ["movie"],
        ["genre"],
        20,
    )


@query(
    "q_cross_sample",
    "J06 SL-04",
    f"""
WITH m AS (SELECT c_name AS movie FROM customer ORDER BY {stable_sql("1", "c_custkey")}, c_custkey LIMIT 10),
     g AS (SELECT p_name AS genre FROM part ORDER BY {stable_sql("2", "p_partkey")}, p_partkey LIMIT 5)
SELECT movie, genre FROM m, g ORDER BY movie, genre LIMIT 20""",
)
def cross_sample(t):
    """Product of two random samples, drawn in a repeatable order."""
    movies = sample_rows(_movies(t), 10, salt=1, by=["id"]).select("movie")
    parts = t.part.select("p_partkey", F.col("p_name").alias("genre"))
    genres = sample_rows(parts, 5, salt=2, by=["p_partkey"]).select("genre")
    return product_top(movies, genres, ["movie"], ["genre"], 20)


@query(
    "q_comma_join",
    "J07 AG-11",
    f"""
WITH pairs AS (SELECT c_custkey AS id, c_name AS movie, o_orderkey, o_orderpriority FROM customer, orders WHERE c_custkey = o_custkey),
picked AS (SELECT DISTINCT movie, id FROM pairs ORDER BY movie, id LIMIT 10),
parts AS (SELECT movie, id, o_orderpriority, {part_sql("id, movie", "o_orderpriority, o_orderkey")} AS part
          FROM pairs JOIN picked USING (movie, id))
SELECT movie, part, array_to_string(list_sort(list(o_orderpriority)), ',') AS genres FROM parts GROUP BY movie, id, part""",
)
def comma_join(t):
    o = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("genre"))
    # The groups are picked from the keys alone; only their rows are joined, and stored, as they are read more than once.
    first = with_rows(_movies(t), o, "id", "o_custkey").select("movie", "id").orderBy("movie", "id").limit(10)
    rows = cut(first.join(o, F.col("id") == F.col("o_custkey")), "rows-of-groups")
    parts = collect_parts(rows, ["movie", "id"], "genre", ["o_orderkey"], out="genres")
    return parts.select("movie", "part", F.array_join("genres", ",").alias("genres")).orderBy("movie", "part")


def _actors(t):
    return t.customer.select("c_custkey", F.col("c_name").alias("last_name"), F.col("c_mktsegment").alias("first_name"))


def _films(t):
    return t.lineitem.filter(in_year("l_shipdate", 1997)).select(
        "l_orderkey", F.concat(F.lit("film"), F.col("l_partkey").cast("string")).alias("film"),
        F.year("l_shipdate").alias("year"),
    )


def _roles(t, actors=None):
    """Actors (default: all) with their films of one year: customer, orders, lineitem."""
    films, roles, actors = _films(t), t.orders.select("o_orderkey", "o_custkey"), _actors(t) if actors is None else actors
    return (
        actors.join(roles, F.col("c_custkey") == F.col("o_custkey"))
        .join(films, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("first_name", "last_name", "film", "year", "o_orderkey")
    )


_ROLES_SQL = """
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE year(l_shipdate) = 1997 GROUP BY c_mktsegment, c_name ORDER BY c_name, c_mktsegment LIMIT 20"""


@query(
    "q_actors_year_prewhere",
    "J01 PF-04 AG-11",
    f"""
WITH roles AS (
    SELECT c_mktsegment AS first_name, c_name AS last_name, 'film' || CAST(l_partkey AS VARCHAR) AS film, o_orderkey
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE year(l_shipdate) = 1997),
picked AS (SELECT DISTINCT last_name, first_name FROM roles ORDER BY ALL LIMIT 20),
parts AS (SELECT last_name, first_name, film, {part_sql("last_name, first_name", "film, o_orderkey")} AS part
          FROM roles JOIN picked USING (last_name, first_name))
SELECT first_name, last_name, part, array_to_string(list_sort(list(film)), ',') AS movies FROM parts GROUP BY 1, 2, 3""",
)
def actors_year_prewhere(t):
    names = ["last_name", "first_name"]
    of_year = with_rows(t.orders.select("o_orderkey", "o_custkey"), _films(t), "o_orderkey", "l_orderkey")
    first = with_rows(_actors(t), of_year, "c_custkey", "o_custkey").select(*names).distinct().orderBy(*names).limit(20)
    rows = cut(_roles(t, _actors(t).join(first, names, "left_semi")), "rows-of-groups")
    parts = collect_parts(rows, ["last_name", "first_name"], "film", ["film", "o_orderkey"], out="movies")
    return parts.select("first_name", "last_name", "part", F.array_join("movies", ",").alias("movies")).orderBy(
        "last_name", "first_name", "part"
    )


@query(
    "q_actors_year_any",
    "J01 AG-11 AG-12",
    f"""
SELECT c_mktsegment AS first_name, c_name AS last_name,
       count(*) AS movies, CAST(any_value(year(l_shipdate)) AS INTEGER) AS year {_ROLES_SQL}""",
)
def actors_year_any(t):
    return (
        _roles(t)
        .groupBy("first_name", "last_name")
        .agg(F.count("film").alias("movies"), F.any_value("year").alias("year"))
        .orderBy("last_name", "first_name")
        .limit(20)
    )


@query("q_actors_year_names", "J01", f"SELECT c_mktsegment AS first_name, c_name AS last_name {_ROLES_SQL}")
def actors_year_names(t):
    return _roles(t).select("first_name", "last_name").distinct().orderBy("last_name", "first_name").limit(20)


def _emails(t):
    """Dictionary of addresses; customers in debt have none, which exercises the default."""
    return t.customer.filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
    )


_EMAILS = """emails AS (SELECT c_custkey AS user_id, 'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email
                        FROM customer WHERE c_acctbal > 0)"""


@query("dict_scan", "SC-13", f"WITH {_EMAILS} SELECT * FROM emails")
def dict_scan(t):
    return _emails(t)


@query(
    "dict_lookup",
    "J09",
    f"""
WITH {_EMAILS}
SELECT event_id, coalesce(email, '') AS email FROM events e LEFT JOIN emails d ON e.user_id = d.user_id""",
)
def dict_lookup(t):
    found = lookup(t.events.select("event_id", "user_id"), _emails(t), "user_id", "user_id", {"email": ""})
    return found.select("event_id", "email")


@query(
    "dict_lookup_hot",
    "J09",
    f"""
WITH {_EMAILS}
SELECT event_id, coalesce(email, '') AS email
FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 3 = 1 AND event_id % 4 = 0 THEN NULL ELSE user_id END AS k FROM events) e
LEFT JOIN emails d ON k = d.user_id""",
)
def dict_lookup_hot(t):
    """A third of the events belong to one user; frequent keys are joined apart from the others."""
    key = F.when(F.col("event_id") % 3 == 0, 7).when((F.col("event_id") % 3 == 1) & (F.col("event_id") % 4 == 0), None).otherwise(F.col("user_id"))
    found = lookup(t.events.select("event_id", key.cast("long").alias("k")), _emails(t), "k", "user_id", {"email": ""}, hot=0.05)
    return found.select("event_id", "email")


@query(
    "star_hot",
    "J08",
    """
SELECT l_orderkey, l_linenumber, p_name, s_name FROM (SELECT *, CASE WHEN l_linenumber = 1 THEN 1 ELSE l_suppkey END AS k FROM lineitem)
JOIN part ON l_partkey = p_partkey JOIN supplier ON k = s_suppkey""",
)
def star_hot(t):
    """A star in which one supplier holds a large share of the fact rows."""
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linenumber") == 1, F.lit(1)).otherwise(F.col("l_suppkey")).cast("long").alias("k"))
    wide = star(fact, (t.part.select("p_partkey", "p_name"), "l_partkey", "p_partkey"), (t.supplier.select("s_suppkey", "s_name"), "k", "s_suppkey"), hot=0.02)
    return wide.select("l_orderkey", "l_linenumber", "p_name", "s_name")


@query(
    "q_dict_running_sum",
    "J09 WN-01",
    f"""
WITH {_EMAILS}
SELECT coalesce(d.email, '') AS email, e.event_type AS action, e.value AS expense,
       round_to(sum(e.value) OVER (PARTITION BY e.user_id, e.event_type ORDER BY e.value
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS expense_accum
FROM events e LEFT JOIN emails d ON e.user_id = d.user_id""",
)
def dict_running_sum(t):
    actions = t.events.select("event_id", "user_id", F.col("event_type").alias("action"), F.col("value").alias("expense"))
    summed = running_sum(actions, ["user_id", "action"], "expense", "expense", out="expense_accum", tie=["event_id"])
    return (
        lookup(summed, _emails(t), "user_id", "user_id", {"email": ""})
        .select("email", "action", "expense", round_to("expense_accum", 2).alias("expense_accum"))
        .orderBy("email", "action", "expense")
    )


@query(
    "q_menu_denorm",
    "J08 SK-05",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice AS price, p_partkey AS dish_id, p_name AS dish_name,
       s_suppkey AS menu_page_id, s_name AS menu_page_name, n_nationkey AS menu_id, n_name AS menu_name
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey""",
)
def menu_denorm(t):
    wide = star(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("price")),
        (t.part.select(F.col("p_partkey").alias("dish_id"), F.col("p_name").alias("dish_name")), "l_partkey", "dish_id"),
        (
            t.supplier.select(F.col("s_suppkey").alias("menu_page_id"), F.col("s_name").alias("menu_page_name"), "s_nationkey"),
            "l_suppkey",
            "menu_page_id",
        ),
        (t.nation.select(F.col("n_nationkey").alias("menu_id"), F.col("n_name").alias("menu_name")), "s_nationkey", "menu_id"),
    ).drop("l_partkey", "l_suppkey", "s_nationkey")
    return create_as(wide, new_path(t.spark, "menu-denorm"))


@query(
    "menu_spread_days",
    "WN-02 SO-05 FN-26",
    f"""
SELECT DATE '2024-01-01' + CAST({stable_sql("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")} % 564 AS INTEGER) AS date,
       count(*) AS items
FROM lineitem GROUP BY 1""",
)
def menu_spread_days(t):
    """Line items spread evenly over 564 days by hash: rows per day."""
    spread = spread_days(t.lineitem, "2024-01-01", 564, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return spread.groupBy("date").agg(F.count(F.lit(1)).alias("items")).orderBy("date")
