"""The pipeline against its stages done plainly one after the other."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from brookmill.llm import pieces
from brookmill.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.test_minhash import brute
from tests.llm.test_tiling import decide, fold


def test_run_equals_plain_stages(spark):
    good = {r["doc_id"] for r in QUERIES["op1_quality"](spark, SMALL).filter("predicted = 1").collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if r["doc_id"] in good)
    first = {}
    for key, text in rows:
        first.setdefault("".join(c.lower() if c.isascii() else c for c in text), (key, text))
    rows = sorted(first.values())
    rows = [r for r, c in zip(rows, brute(spark, rows)) if r[0] == c]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    grams = {tuple(w[i : i + 5]) for w in (fold(t) for _, t in bench) for i in range(len(w) - 4)}
    suspects = [r for r in rows if any(tuple(w[i : i + 5]) in grams for w in [fold(r[1])] for i in range(len(w) - 4))]
    leaks = {k for k, (items, _) in decide(suspects, bench).items() if items}
    assert leaks
    want = {k for k, _ in rows} - leaks
    assert len(want) > 100

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) == want and all(r["lossless"] for r in got.values())
    direct = pieces.piece_ids(docs, str(public_tokenizers.path(corpus_pipeline.MODEL)), dropout=0.1, seed=20).collect()
    assert all(r["ids"] == got[r["doc_id"]]["ids"] for r in direct if r["doc_id"] in want)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
