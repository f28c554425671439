"""The mix against plain loops; the query is held against SQL in test_plain."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from brookmill.llm import curriculum
from brookmill.llm.curriculum import SCHEDULES, Schedule
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes: dict, weights, share=1.5, most=2):
    """Share, cut and share again until no target is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not above:
            out |= {s: level * weight[s] for s in open_}
            break
        for s in above:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= above
    return out


def plain(rows, seed=42):
    docs = [(k, s, len(WORD.findall(t or ""))) for k, t, s in rows]
    sizes = defaultdict(int)
    for _, s, n in docs:
        sizes[s] += n
    goal = targets(sizes, [x.integral for x in SCHEDULES])
    out = []
    for s in sizes:
        at, quota = 0, int(goal[s] + 0.5)
        mine = [(k, n) for k, other, n in docs if other == s]
        mine.sort(key=lambda d: (hashlib.md5(f"{seed}:{'' if d[0] is None else d[0]}:{d[1]}".encode()).hexdigest(), d[0] is not None, d[0] or 0))
        for k, n in mine:
            parts = [max(0, min(quota - at - i * sizes[s], n)) for i in (0, 1)]
            out.append((k, n, sizes[s], round(goal[s], 6), sum(parts), tuple(p for p in parts if p)))
            at += n
    return sorted(out, key=str)


def _got(df, **how):
    return sorted(((r[0], r["size"], r["source_size"], round(r["target"], 6), r["taken"], tuple(p["words"] for p in r["passes"])) for r in curriculum.curriculum(df, **how).collect()), key=str)


def test_documents_equal_plain_loops(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
    got = _got(df)
    assert got == plain(rows) == _got(df, bucket_rows=3)
    taken, target = defaultdict(int), {}
    for key, (_, _, s, goal, words, _) in zip([g[0] for g in got], got):
        taken[s] += words
        target[s] = goal
    assert all(abs(taken[s] - target[s]) <= 1 for s in taken)


@pytest.mark.parametrize("bucket_rows", [2, 10_000])
def test_edges(spark, bucket_rows):
    rows = [(1, "a b c", "x"), (2, None, "x"), (3, "", "y"), (None, "d e", "y"), (4, "f " * 400, None), (5, "g h i", None), (6, "j", ""), (6, "j", ""), (7, "k\x0bl", "Z"), (8, "m n o p", "é"), (9, " ", "none here")]
    rows += [(100 + i, "w " * (i % 7), "hot") for i in range(300)]
    df = spark.createDataFrame([(*r, "d", 1.5, 3) for r in rows], "doc_id long, text string, source string, draw string, size double, bucket int").repartition(6)
    got = _got(df, bucket_rows=bucket_rows)
    assert got == plain(rows) and all(g[4] <= 2 * g[1] for g in got)
    assert curriculum.curriculum(df.limit(0)).count() == 0
    none = curriculum.curriculum(df.filter("doc_id IN (2, 3, 9)")).collect()
    assert [(r["size"], r["target"], r["taken"], r["passes"]) for r in none] == [(0, 0.0, 0, [])] * 3


def test_rows_come_in_the_order_of_positions(spark):
    rows = curriculum.curriculum(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    first = [r["passes"][0]["position"] for r in rows if r["passes"]]
    assert first == sorted(first) and 0 <= first[0] and first[-1] < 1
    assert all(not r["passes"] for r in rows[len(first) :])
    twice = [r["passes"] for r in rows if len(r["passes"]) == 2]
    assert all(a["position"] < b["position"] for a, b in twice)


def test_positions_follow_the_demand(spark):
    """Up to any time, a source has given as many words as the integral of its schedule asks for."""
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.element_at(F.array(F.lit("s0"), F.lit("s1"), F.lit("s2")), (F.col("id") % 3 + 1).cast("int")).alias("source"))
    out = curriculum.curriculum(df).join(df.select("doc_id", "source"), "doc_id").select("source", "target", F.explode("passes").alias("p")).select("source", "target", "p.*").collect()
    for s, schedule in zip(("s0", "s1", "s2"), SCHEDULES):
        (_, w0), (_, w1) = schedule.knots
        goal = next(r["target"] for r in out if r["source"] == s)
        for t in (0.1, 0.35, 0.8):
            want = goal * (w0 * t + (w1 - w0) * t * t / 2) / schedule.integral
            assert abs(sum(r["words"] for r in out if r["source"] == s and r["position"] < t) - want) <= 4


def test_schedules_of_several_lines(spark):
    schedule = Schedule(((0.0, 0.0), (0.25, 4.0), (0.5, 0.0), (0.75, 0.0), (1.0, 1.0)))
    parts = [0.0, 0.1, 0.3999, 0.5, 0.8, 0.9, 0.999]
    times = [r[0] for r in spark.createDataFrame([(i, p) for i, p in enumerate(parts)], "i int, p double").orderBy("i").select(schedule.time_at(F.col("p"))).collect()]

    def area(t):
        return sum((w0 + (w0 + (w1 - w0) * (min(t, b) - a) / (b - a))) * (min(t, b) - a) / 2 for (a, w0), (b, w1) in zip(schedule.knots, schedule.knots[1:]) if t > a)

    assert all(abs(area(t) - p * schedule.integral) < 1e-12 for t, p in zip(times, parts)) and times == sorted(times)
    for bad in (((0.0, 1.0),), ((0.1, 1.0), (1.0, 1.0)), ((0.0, 0.0), (1.0, 0.0)), ((0.0, 1.0), (1.0, -1.0))):
        with pytest.raises((ValueError, IndexError)):
            Schedule(bad)


def test_targets_equal_sharing_in_rounds(spark):
    import random

    rng = random.Random(4)
    sizes = {f"0{i:03d}": rng.choice([0, 1, 3, 10, 100, 5000]) for i in range(60)}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    for share in (0.2, 1.5, 1.99):
        got = {r["source"]: r["target"] for r in curriculum.source_targets(frame, share=share).collect()}
        want = targets(sizes, [5.0, 2.0, 1.0], share)
        assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)
