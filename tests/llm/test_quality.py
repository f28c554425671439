"""The classifier: gradients, held-out accuracy, whole texts and edges."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from brookmill.llm import quality
from brookmill.llm.queries import QUERIES
from tests.conftest import MIDDLE


def test_gradients():
    shape = quality.Shape(3, 4, 5, 4)
    net = quality.Network(shape, 1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, (5, quality.CHUNK + 3)).astype(np.uint8)
    owner, label = np.array([0, 0, 1, 2, 2]), np.array([1, 0, 1])

    def loss():
        docs = [data[owner == i] for i in range(3)]
        total = 0.0
        for rows, y in zip(docs, label):
            hidden = []
            for row in rows:
                seen = net.w["embed"][row].reshape(-1)
                answers = np.array([seen[i * 3 : i * 3 + 12] @ net.w["conv"] for i in range(quality.CHUNK)])
                hidden.append(np.maximum(np.maximum(answers.max(0) + net.w["conv_b"], 0) @ net.w["dense"] + net.w["dense_b"], 0))
            p = 1 / (1 + np.exp(-(np.mean(hidden, 0) @ net.w["out"] + net.w["out_b"][0])))
            total -= np.log(p if y else 1 - p) / 3
        return total

    grads = net.gradients(data, owner, 3, label, np.ones(3))
    for name, w in net.w.items():
        flat, step = w.reshape(-1), 1e-6
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            flat[i] += step
            up = loss()
            flat[i] -= 2 * step
            down = loss()
            flat[i] += step
            assert grads[name].reshape(-1)[i] == pytest.approx((up - down) / (2 * step), abs=2e-5), name


def test_score_does_not_depend_on_neighbours():
    net = quality.Network(quality.Shape(), 3)
    rng = np.random.default_rng(4)
    texts = [rng.integers(1, 255, n).astype(np.uint8).tobytes() for n in (0, 1, 58, 59, 60, 64, 250, 251, 256, 300, 5000, 70000)]
    together = net.score(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    alone = [net.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)
    longer = texts[-1][:-1] + b"\x00"
    assert net.score(np.frombuffer(longer, np.uint8), np.array([0, len(longer)])).shape == (1,)


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    rows = QUERIES["op1_quality"](spark, MIDDLE).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = np.mean([r["predicted"] == labels[r["doc_id"]] for r in held])
    assert len(held) > 60 and right > 0.93


def test_edges(spark):
    schema = "doc_id long, text string, score double, y int"
    rows = [(1, None), (2, ""), (None, "plain text"), (4, "x" * 100000), (5, "same"), (5, "same")]
    df = spark.createDataFrame([(*r, 0.0, 1) for r in rows], schema)
    known = spark.createDataFrame([(None, 1), (2, None), (5, 1), (5, 1)], "doc_id long, quality int")
    got = quality.quality_scores(df, known).collect()
    assert len(got) == 6 and {r["score"] for r in got} == {1.0}
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    kept = quality.quality_scores(df, known.limit(0), keep_columns=True)
    assert kept.columns == df.columns and kept.count() == 6
    assert quality.quality_scores(df.limit(0), known).count() == 0
