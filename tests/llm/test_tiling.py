"""Greedy string tiling against a plain form, and edges."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from brookmill.llm import tiling
from tests.conftest import SMALL


def fold(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_tiles(item, text, shortest):
    """Mark the longest common run of unmarked words again and again."""
    free_i, free_t, covered = [True] * len(item), [True] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and free_i[i + n] and free_t[j + n] and item[i + n] == text[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < shortest:
            return covered
        free_i[i : i + n] = [False] * n
        free_t[j : j + n] = [False] * n
        covered += n


def arrays(words):
    return np.array([hash(w) & (2**63 - 1) | 1 for w in words], np.uint64)


def test_tiles_cover_as_the_plain_form():
    rng = random.Random(4)
    for _ in range(60):
        item = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 25))]
        text = []
        for _ in range(rng.randint(1, 5)):
            i = rng.randrange(len(item))
            text += item[i : i + rng.randint(1, 12)] + [rng.choice("xyz") for _ in range(rng.randint(0, 3))]
        found = tiling.tiles(arrays(item), arrays(text), 3)
        places = [x for i, _, n in found for x in range(i, i + n)]
        assert len(places) == len(set(places))
        assert all(item[i : i + n] == text[j : j + n] and n >= 3 for i, j, n in found)
        assert sum(n for _, _, n in found) == plain_tiles(item, text, 3)


def decide(rows, bench, coverage=0.5, shortest=5):
    out = {}
    for key, text in rows:
        words = fold(text)
        shares = {}
        for item, body in bench:
            own = fold(body)
            if own and set(own) & set(words):
                share = plain_tiles(own, words, min(shortest, len(own))) / len(own)
                if share >= coverage:
                    shares[item] = share
        out[key] = (sorted((i for i in shares if i is not None)) + [None] * (None in shares), max(shares.values(), default=0.0))
    return out


SENTENCES = ["the quick brown fox jumps over it", "a lazy dog sleeps near the old barn", "nobody knew where the seven keys were", "rain fell on the quiet village all night"]


@pytest.fixture
def bench(spark):
    rows = [(1, ". ".join(SENTENCES)), (2, "One two three"), (3, None), (4, "!!"), (None, "zero null item words here now"), (1, ". ".join(SENTENCES)), (6, "é à ü ö ß œ")]
    return rows, spark.createDataFrame([(*r, 7, "x") for r in rows], "item_id long, text string, doc_id int, mark string")


def test_small_cases(spark, bench):
    items, frame = bench
    moved = " And then ".join([SENTENCES[2], SENTENCES[0], SENTENCES[3]])
    rows = [
        (10, "Start. " + moved.upper() + "!"),
        (11, SENTENCES[0] + " but little else of it"),
        (12, "one TWO, three"),
        (13, None),
        (14, ""),
        (15, "clean words only"),
        (16, "pad " * 20000 + ". ".join(SENTENCES)),
        (17, "x zero null item words here now y é à ü ö ß œ"),
        (None, ". ".join(SENTENCES)),
        (18, " ".join(f"w{i}" for i in range(30000))),
        (18, " ".join(f"w{i}" for i in range(30000))),
    ]
    df = spark.createDataFrame([(*r, "m", 1) for r in rows], "doc_id long, text string, mark string, item_id int").repartition(4)
    got = [(r["doc_id"], (r["items"], r["best_coverage"])) for r in tiling.contaminated(df, frame).collect()]
    want = decide([r for r in rows if len(r[1] or "") < 2000], [i for i in items if i[1]])
    assert len(got) == len(rows)
    for key, value in got:
        if key not in (16, 18):
            assert value == want[key], key
    assert dict(got)[10][0] == [1] and dict(got)[11][0] == [] and dict(got)[16][0] == [1] and dict(got)[17][0] == [6, None]
    left = tiling.without_contaminated(df, frame)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [11, 13, 14, 15, 18, 18]


def test_empty_tables(spark, bench):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tiling.contaminated(none, bench[1]).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert tiling.contaminated(some, bench[1].limit(0)).first()["contaminated"] is False


def test_query_finds_every_whole_item(spark):
    from brookmill.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    bench = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op8_string_tiling"](spark, SMALL).collect()}
    assert set(got) == set(docs)
    whole = {d: sorted(i for i, t in bench.items() if t in text) for d, text in docs.items()}
    assert sum(map(bool, whole.values())) > 0
    for d, items in whole.items():
        assert set(items) <= set(got[d]["items"])
