from __future__ import annotations

import random
from collections import Counter

import pytest

from brookmill.operators import merge as M
from brookmill.operators.sketches import distinct_state, require_state_types


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_latest_by_key(spark):
    df = spark.createDataFrame([("pump", "north", 3.5, 10), ("pump", "north", 2.25, 40), ("pump", "south", 9.0, 20), ("fan", "north", None, 5)], "device string, hall string, load double, seq int")
    got = M.latest_by_key(df, ["device", "hall"], "seq").select("device", "hall", "load")
    assert rows(got) == Counter([("pump", "north", 2.25), ("pump", "south", 9.0), ("fan", "north", None)])


def test_equal_seq_is_reported(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "c")], "k int, seq int, v string")
    assert rows(M.equal_seq(df, ["k"], "seq")) == Counter([(1, 1, 2)])
    assert M.latest_by_key(df, ["k"], "seq").count() == 2


def test_sum_by_key(spark):
    df = spark.createDataFrame([("red", 40, "x"), ("blue", 2, "y"), ("red", -15, "z"), ("red", 7, "x")], "colour string, points int, note string")
    assert rows(M.sum_by_key(df, ["colour"], ["points"])) == Counter([("red", 32), ("blue", 2)])
    with pytest.raises(TypeError):
        M.sum_by_key(df, ["colour"], ["note"])


BOOKINGS = [
    ("room 4", "june", 80.0, "ann", 1, 1),
    ("room 4", "june", 80.0, "ann", -1, 2),
    ("room 4", "june", 95.5, "bea", 1, 3),
    ("room 9", "june", 60.0, "cal", 1, 1),
    ("room 9", "june", 60.0, "cal", -1, 4),
]
LOG_SCHEMA = "id int, status string, price string, comment string, sign int, seq int"


def test_collapse(spark):
    df = spark.createDataFrame(BOOKINGS, "room string, month string, fee double, guest string, sign int, seq int")
    got = M.collapse(df, ["room", "month"], "sign", "seq")
    assert rows(got) == Counter([("room 4", "june", 95.5, "bea", 1, 3)])


def test_collapse_rules(spark):
    log = [
        (1, "a", "p", "first", -1, 1),
        (1, "a", "p", "second", -1, 2),
        (2, "a", "p", "x", 1, 1),
        (2, "a", "p", "x", -1, 2),
        (3, "a", "p", "one", 1, 1),
        (3, "a", "p", "two", 1, 2),
    ]
    got = M.collapse(spark.createDataFrame(log, LOG_SCHEMA), ["id", "status"], "sign", "seq")
    assert rows(got.select("id", "comment", "sign")) == Counter([(1, "first", -1), (3, "two", 1)])


REVISIONS = [
    ("dune", 12, 400, 1, 7),
    ("dune", 12, 400, -1, 7),
    ("dune", 15, 410, 1, 8),
    ("emma", 3, 90, 1, 2),
]
REVISION_SCHEMA = "book string, copies int, pages int, sign int, version int"


@pytest.mark.parametrize("seed", range(4))
def test_collapse_versioned_in_any_order(spark, seed):
    log = REVISIONS[:]
    random.Random(seed).shuffle(log)
    got = M.collapse_versioned(spark.createDataFrame(log, REVISION_SCHEMA).repartition(3), ["book"], "version", "sign")
    assert rows(got) == Counter([("dune", 15, 410, 1, 8), ("emma", 3, 90, 1, 2)])


def test_signed_totals_equal_totals_after_collapse(spark):
    df = spark.createDataFrame(REVISIONS, REVISION_SCHEMA)
    signed = {r["book"]: r for r in M.signed_totals(df, ["book"], ["copies", "pages"], "sign").collect()}
    kept = M.collapse_versioned(df, ["book"], "version", "sign").collect()
    assert {(b, r["rows"], r["copies"], r["pages"]) for b, r in signed.items()} == {(r["book"], 1, r["copies"], r["pages"]) for r in kept}


def test_states_merge_and_reject_plain_values(spark):
    from pyspark.sql import functions as F

    visits = spark.createDataFrame([("gate a", "mon", 51), ("gate a", "mon", 51), ("gate b", "tue", 87)], "gate string, day string, user long")
    states = visits.groupBy("gate", "day").agg(distinct_state("user").alias("user_uniq"))
    merged = states.groupBy("gate", "day").agg(F.hll_sketch_estimate(F.hll_union_agg("user_uniq")).alias("n"))
    assert [r["n"] for r in merged.collect()] == [1, 1]
    require_state_types(states, states)
    with pytest.raises(TypeError):
        require_state_types(visits.withColumnRenamed("user", "user_uniq"), states)
    with pytest.raises(ValueError):
        require_state_types(visits, states)
