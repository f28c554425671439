"""Ledgers of files, offset ranges, exact bitmaps, gaps, pinned dictionaries and late rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from brookmill.operators import sketches
from brookmill.operators.gapfill import _BLOCK, fill_gaps
from brookmill.operators.tables import move_into
from brookmill.scratch import new_path
from brookmill.sources import files as S
from brookmill.sources import topics as K
from brookmill.streaming.hours import HourlySums
from brookmill.streaming.pinned import PinnedDictionary


def test_a_late_old_file_is_taken_once(spark, path):
    folder, late = f"{path}/in", f"{path}/late"
    rows = spark.range(60).withColumn("v", F.lit("x"))
    S.write_csv(rows.filter("id < 20").repartition(2), late)
    S.write_csv(rows.filter("id >= 20").repartition(3), folder)
    ledger, seen = S.FileLedger(spark, f"{path}/ledger"), []
    assert ledger.take("a", folder, ".csv", seen.extend, limit=2) == 2
    assert ledger.take("a", folder, ".csv", seen.extend, limit=2) == 2 and seen[:2] == seen[2:]
    assert ledger.take("b", folder, ".csv", seen.extend) == 1 and ledger.take("c", folder, ".csv", seen.extend) == 0
    newest = max(r["modificationTime"] for r in S.new_files(spark, folder, ".csv", limit=None).collect())
    assert move_into(spark, late, folder) == 2
    assert all(r["modificationTime"] < newest for r in ledger.new(folder, ".csv").collect())
    assert ledger.take("c", folder, ".csv", seen.extend, limit=1) == 1 and ledger.take("d", folder, ".csv", seen.extend) == 1
    assert ledger.take("e", folder, ".csv", seen.extend) == 0 and len(set(seen)) == 5 and ledger.taken().count() == 5
    assert S.read_csv(spark, sorted(set(seen)), rows.schema).count() == 60


def _topic(spark, path, low, high):
    spark.range(low, high).selectExpr("CAST(id AS STRING) AS key", "'{}' AS value", "CAST(id % 3 AS INT) AS partition", "id AS offset", "CAST(0 AS TIMESTAMP) AS timestamp").write.mode("append").parquet(path)
    return spark.read.schema(K.TOPIC_SCHEMA).parquet(path)


def test_offset_batches_meet_without_gap_or_overlap(spark, path):
    log = f"{path}/log"
    batches = K.OffsetBatches(_topic(spark, f"{path}/topic", 5, 100), log)
    assert batches.plan(1, most=20) == 3
    first = {r["offset"] for r in batches.read(1).collect()}
    assert len(first) < 95
    batches = K.OffsetBatches(_topic(spark, f"{path}/topic", 100, 200), log)
    assert batches.plan(1) == 3 and {r["offset"] for r in batches.read(1).collect()} == first
    assert batches.plan(2, most=50) == 3 and batches.plan(3) == 3
    parts = [{r["offset"] for r in batches.read(b).collect()} for b in (1, 2, 3)]
    assert set.union(*parts) == set(range(5, 200)) and sum(map(len, parts)) == 195
    assert batches.plan(4) == 0 and batches.read(4).count() == 0 and batches.ranges().count() == 9
    options = batches.broker_options(2, "t")
    assert options["startingOffsets"] == '{"t": {"0": 26, "1": 27, "2": 25}}' and '"t"' in options["endingOffsets"]
    text = batches.read(2)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "GreaterThanOrEqual(offset,26)" in text


def test_bitmaps_count_exactly_at_any_grain(spark):
    rng = random.Random(2)
    rows = [(k, m, None if i % 50 == 0 else rng.choice([0, 1, 32767, 32768, 99999, rng.randint(0, 200_000)])) for i, (k, m) in enumerate((rng.choice("ab"), rng.randint(1, 4)) for _ in range(4000))]
    df = spark.createDataFrame(rows, "k string, m int, id long")
    states = sketches.distinct_bitmaps(df, ["k", "m"], "id")
    for keys in (["k"], ["m"], ["k", "m"]):
        want = {tuple(r): None for r in []} or {tuple(r[c] for c in keys): r["n"] for r in df.groupBy(*keys).agg(F.countDistinct("id").alias("n")).collect()}
        assert {tuple(r[c] for c in keys): r["n"] for r in sketches.count_bitmaps(states, keys, "n").collect()} == want
    merged = sketches.merge_bitmaps(states, ["k"])
    assert merged.columns == ["k", "bits_bucket", "ids_bits"]
    assert sketches.count_bitmaps(sketches.distinct_bitmaps(df.limit(0), ["k"], "id"), ["k"], "n").count() == 0


def test_sketch_values_hold_their_bounds(small):
    from brookmill.plans import load_all

    for r in load_all()["agg_uniq_sketch_values"].build(small).collect():
        assert abs(r["approx_parts"] - r["parts"]) <= max(1, 0.06 * r["parts"]) and abs(r["merged_parts"] - r["parts"]) <= max(1, 0.03 * r["parts"])


@pytest.mark.parametrize("step", [1, 60])
def test_gaps_of_long_series_with_few_rows(spark, step):
    """Series with rows in few blocks, at the ends of blocks, off the grid, without a bucket, and with a null name."""
    at = {"a": [0, _BLOCK - 1, _BLOCK, 5 * _BLOCK + 3], "b": [2 * _BLOCK], "c": [7 * _BLOCK - 1], None: [3, 3]}
    rows = [(k, p * step + 100, 1) for k, ps in at.items() for p in ps] + [("a", None, 1)] + ([("d", 100 + step + 1, 1)] if step > 1 else [])
    df = spark.createDataFrame(rows, "k string, t long, n int")
    got = fill_gaps(df, "t", step, {"n": 0}, per=["k"])
    grid = range(100, 100 + 7 * _BLOCK * step, step)
    series = {r[0] for r in rows}
    want = [(k, t, 0) for k in series for t in set(grid) - {r[1] for r in rows if r[0] == k}] + rows
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    overall = fill_gaps(df.drop("k"), "t", step, {"n": 0})
    want = [(t, 0) for t in set(grid) - {r[1] for r in rows}] + [r[1:] for r in rows]
    assert sorted(map(tuple, overall.collect()), key=str) == sorted(want, key=str)


def test_a_dictionary_lives_between_its_bounds(spark, path):
    now, reads = {"t": 1000.0}, []

    def read():
        reads.append(now["t"])
        return spark.createDataFrame([(len(reads),)], "v int")

    pinned = PinnedDictionary(spark, path, read, least=300, most=600, clock=lambda: now["t"])
    value = lambda batch: pinned.for_batch(batch).first()["v"]
    assert 300 <= pinned.lifetime(0) <= 600 and pinned.lifetime(0) != pinned.lifetime(1)
    assert value(0) == 1
    now["t"] += 299
    assert value(1) == 1 and len(reads) == 1
    now["t"] += 302
    assert value(2) == 2 and value(0) == 1 and value(1) == 1 and len(reads) == 2
    again = PinnedDictionary(spark, path, read, least=300, most=600, clock=lambda: now["t"] + 10_000)
    assert again.for_batch(2).first()["v"] == 2 and again.for_batch(3).first()["v"] == 3
    with pytest.raises(ValueError, match="least"):
        PinnedDictionary(spark, path, read, least=5, most=1)


def test_late_rows_are_kept_and_replays_count_once(spark, path):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    frame = lambda rows: spark.createDataFrame(rows, "ts timestamp_ntz, k string, v int")
    hours = HourlySums(spark, path, "ts", ["k"], {"total": F.col("v")})
    hours.add(frame([(at(1, 5), "a", 1), (at(2, 30), "a", 2)]), 0)
    assert hours.late_rows().count() == 0 and hours.closed_hours().count() == 0
    second = frame([(at(1, 50), "a", 4), (at(5), "b", 8)])
    hours.add(second, 1)
    third = frame([(at(1, 59), "a", 16), (at(4, 30), "b", 32), (None, "b", 64)])
    for _ in range(2):
        hours.add(third, 2)
        hours.add(second, 1)
    assert [(r["hour"], r["k"], r["n"], r["total"]) for r in hours.closed_hours().orderBy("hour").collect()] == [(at(1), "a", 2, 5), (at(2), "a", 1, 2)]
    assert sorted((str(r["ts"]), r["v"], r["batch_id"]) for r in hours.late_rows().collect()) == [(str(at(1, 59)), 16, 2), ("None", 64, 2)]
