"""Piece ids against the library, the heap form, and exact round trips."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

from brookmill.llm import pieces
from tests.conftest import SMALL

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))
ODD = ["", " ", "  ", "a", " a  b ", "\n\n x\n", "▁a b▁", "ﬁ é é\tx\x00", "日本語テキスト😀 😀😀", "word" * 40, "x" * 300 + " " + " " * 70 + "y", "<s> </s> <unk> <0x41>", "go " * 20000]


@pytest.fixture(scope="module")
def model():
    return pieces.load(PATH)


def split(ids, edges):
    return [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])]


def test_without_dropout_as_the_library(model, small):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [t for t in ODD if "▁" not in t] + [r["text"] for r in small.documents.collect()]
    got = split(*pieces.encode_texts(model, texts, np.zeros(len(texts)), 0.0, 0, 1))
    assert got == [library.encode(t) for t in texts]


def test_round_trip_and_variety(model):
    texts = ODD + ["international communication"] * 30
    keys = np.arange(len(texts))
    ids, edges = pieces.encode_texts(model, texts, keys, 0.3, 5, 16)
    data, reach = pieces.decode_ids(model, ids, edges)
    assert [data[a:b].tobytes().decode() for a, b in zip(reach[:-1], reach[1:])] == texts
    again, _ = pieces.encode_texts(model, texts, keys, 0.3, 5, 16)
    assert (ids == again).all()
    assert len({tuple(x) for x in split(ids, edges)[len(ODD) :]}) > 5
    plain, _ = pieces.encode_texts(model, texts, keys, 0.0, 5, 16)
    assert len(plain) < len(ids)


def test_step_form_equals_heap(model):
    for word in ("international", "unbelievable", "thethethe", "zzzzzz", "a"):
        symbols = [model.space] + [int(model.char_symbol[ord(c)]) for c in word]
        for k in range(60):
            key = np.array([k * 7919 + 13], np.uint64)
            grid, counts = pieces.encode_level(model, np.array([symbols], np.int32), np.array([len(symbols)]), key, 0.3)
            assert grid[0][: counts[0]].tolist() == pieces.encode_long(model, symbols, int(key[0]), 0.3)


def test_frame(spark):
    rows = [(1, None), (None, "a b"), *((10 + i, t) for i, t in enumerate(ODD)), (3, "x y z"), (3, "x y z")]
    df = spark.createDataFrame([(*r, 1, "d") for r in rows], "doc_id long, text string, ids int, decoded string").repartition(3)
    got = pieces.piece_ids(df, PATH, dropout=0.5, compare=True).collect()
    assert len(got) == len(rows) and all(r["lossless"] for r in got)
    assert [r["ids"] for r in got if r["doc_id"] == 1] == [[]]
    assert len({tuple(r["ids"]) for r in got if r["doc_id"] == 3}) == 1
    assert pieces.piece_ids(df.limit(0), PATH).count() == 0


def test_query_decodes_every_text(spark):
    from pyspark.sql import functions as F

    from brookmill.llm.queries import QUERIES

    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("sha"))
    bad = QUERIES["op5_sentencepiece"](spark, SMALL).join(texts, "doc_id").filter("sha <> decoded_sha256 OR n_pieces = 0")
    assert bad.count() == 0


def test_every_occurrence_draws_its_own_dropout(model, spark):
    texts = [f"{i} internationalization of communication" for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    ids = [r["ids"] for r in pieces.piece_ids(df, PATH, dropout=0.3, seed=5).collect()]
    wanted = " internationalization"
    found = set()
    for row in ids:
        at, word = 0, []
        for i in row:
            piece = model.raw[model.raw_start[i] : model.raw_start[i] + model.raw_size[i]].tobytes().decode()
            at += len(piece)
            word.append((at, piece))
        text = "".join(p for _, p in word)
        begin = text.index(wanted)
        found.add(tuple(p for end, p in word if begin < end <= begin + len(wanted)))
    assert len(found) > 16


def test_shared_units_equal_units_encoded_one_by_one(model, monkeypatch):
    texts = ODD + [f"the cat {i} sat on the internationalization mat" for i in range(200)]
    keys = np.arange(len(texts))
    ids, edges = pieces.encode_texts(model, texts, keys, 0.1, 5)
    monkeypatch.setattr(pieces, "apart", lambda kinds, visits, back, keys, dropout: np.ones(len(back), bool))
    one_by_one, other = pieces.encode_texts(model, texts, keys, 0.1, 5)
    assert (edges == other).all() and (ids == one_by_one).all()


@pytest.mark.parametrize("dropout", [0.0, 0.1])
def test_units_that_sums_modulo_two_to_64_mistake(spark, dropout):
    """Units with equal hashes modulo 2**64 keep their own ids."""
    made = lambda n, a, b: "".join((a, b)[bin(i).count("1") % 2] for i in range(n))
    texts = [made(n, *pair) for n in (1024, 2048, 4096) for pair in ("ab", "ba", "xq", "qx")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = pieces.piece_ids(df, PATH, dropout=dropout, seed=3).collect()
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in rows} == dict(enumerate(texts))
