"""Near-duplicate classes against all-pairs brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from brookmill.llm import minhash
from tests.conftest import MIDDLE

SCHEMA = "doc_id long, text string, digest string, doc int, label string, bands int"


def brute(spark, rows, threshold=0.8, damping=0.2):
    """{(key, text): smallest key of the class} by comparing all pairs that share a shingle."""
    content = spark.createDataFrame([((t or "").encode(),) for _, t in rows], "text binary")
    weights = minhash.Weights(*minhash.document_frequencies(content, 5, 1 << 20), damping)
    texts = sorted({t or "" for _, t in rows})
    vectors = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        _, found, counts = minhash.shingles(data, np.array([0, len(data)]), 5)
        vectors.append((found, weights.of(found, counts)))
    where = defaultdict(set)
    for i, (found, _) in enumerate(vectors):
        for h in found.tolist():
            where[h].add(i)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (found, _) in enumerate(vectors):
        for j in {j for h in found.tolist() for j in where[h] if j < i}:
            if minhash.similarity(vectors[i], vectors[j]) >= threshold:
                parent[find(i)] = find(j)
    order = lambda k: -(2**63) if k is None else k
    place = {t: find(i) for i, t in enumerate(texts)}
    least = {}
    for key, t in rows:
        c = place[t or ""]
        least[c] = min((order(key), key), least.get(c, (2**63, None)), key=lambda p: p[0])
    return [least[place[t or ""]][1] for _, t in rows]


def test_query_equals_brute_force(spark):
    from brookmill.llm.queries import QUERIES

    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op9_minhash"](spark, MIDDLE).collect()}
    assert [got[k] for k, _ in rows] == brute(spark, rows)
    assert len(set(got.values())) < len(got) - 50


@pytest.fixture(scope="module")
def copies(spark):
    """A large group of near copies around a hub, most of them not near each other, and odd rows."""
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(5000)}"
    hub = [word() for _ in range(300)]
    rows = [(500, " ".join(hub))]
    for i in range(120):
        text = list(hub)
        for p in rng.sample(range(300), rng.choice([1, 3, 5, 6])):
            text[p] = word()
        rows.append((600 + i, " ".join(text)))
    rows += [(10 + i, " ".join(word() for _ in range(rng.randint(1, 80)))) for i in range(40)]
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  two"), (6, "one two three"), (None, rows[-1][1]), (7, "go " * 3000), (8, "go " * 2990)]
    rows += [rows[3], rows[3], (9, rows[3][1].upper())]
    return rows, spark.createDataFrame([(*r, "d", 1, "l", 2) for r in rows], SCHEMA).repartition(6)


def test_star_of_copies(spark, copies):
    rows, df = copies
    got = minhash.near_duplicates(df, small=4).collect()
    want = dict(zip(rows, brute(spark, rows)))
    texts = {(k, minhash_md5(t)): t for k, t in rows}
    assert len(got) == len(rows)
    for r in got:
        text = texts[r["doc_id"], r["text_md5"]]
        assert r["class_id"] == want[r["doc_id"], text]
    kept = minhash.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(want.values()))


def families(pairs, rng):
    """Pages of one template, similar to each other below the threshold, in pairs that are above it."""
    word = lambda: f"f{rng.randrange(10**6)}"
    template = [word() for _ in range(144)]
    rows = []
    for i in range(pairs):
        both = [word() for _ in range(12)]
        rows += [(k, " ".join(template + both + [word() for _ in range(9)])) for k in (1000 + 2 * i, 1001 + 2 * i)]
    return rows


def classes_of(spark, rows, **parameters):
    df = spark.createDataFrame([(*r, "d", 1, "l", 2) for r in rows], SCHEMA).repartition(6)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df, **parameters).collect()}
    return [got[k] for k, _ in rows]


def test_pairs_within_a_template_are_all_found(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16, raising=False)
    rows = families(60, random.Random(5))
    want = brute(spark, rows)
    assert len(set(want)) == 60
    assert classes_of(spark, rows) == want


def test_linked_classes_go_on_to_their_further_links(spark):
    """Chains of four pages within a template, only neighbours above the threshold, none of them a centre."""
    rng = random.Random(8)
    word = lambda: f"c{rng.randrange(10**6)}"
    template = [word() for _ in range(144)]
    rows = []
    for i in range(15):
        joints = [[word() for _ in range(12)] for _ in range(5)]
        rows += [(2000 + 4 * i + k, " ".join([*template, *joints[k], *joints[k + 1]])) for k in range(4)]
    rng.shuffle(rows)
    want = brute(spark, rows)
    assert len(set(want)) == 15
    assert classes_of(spark, rows) == want


def minhash_md5(text):
    import hashlib

    return hashlib.md5((text or "").encode()).hexdigest()


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_samples_agree_as_often_as_similarity():
    rng = np.random.default_rng(1)
    found = np.sort(rng.integers(1, 2**63, 300, dtype=np.uint64))
    weight = rng.integers(1, 4, 300).astype(np.float32)
    other = weight.copy()
    other[:60] += 1
    a = minhash.samples(np.zeros(300, int), found, weight, 1500)
    b = minhash.samples(np.zeros(300, int), found, other, 1500)
    assert abs((a == b).mean() - minhash.similarity((found, weight), (found, other))) < 0.04


def test_components(spark):
    chain = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(20)] + [(b"x", b"y"), (b"y", b"x"), (b"z", b"z")], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["label"]) for r in minhash.components(chain).collect()}
    assert got == {bytes([i]): bytes([0]) for i in range(1, 21)} | {b"y": b"x"}
