"""Fill-in-the-middle against SQL (test_plain), a walk over units, and an exact round trip."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from brookmill.llm import infilling

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = ["", " ", "one", " \n one", "a  b\tc ", "é 😀 ü", "   x \x1c y", "<P> in it", "< P> <S <M", "a <M", "\x00 b", "word " * 50, "x" * 5000]


@pytest.mark.parametrize("block", [1, 7, 64, infilling.BLOCK])
def test_unit_ends_equal_a_walk(block):
    rng = random.Random(block)
    texts = ODD + ["".join(rng.choices(" \tab\né", k=rng.randint(1, 300))) for _ in range(200)]
    for t in texts:
        assert infilling.unit_ends(t, block) == [m.end() for m in UNIT.finditer(t)]


def test_long_text_is_matched_in_blocks():
    text = " ab c\n" * 100_000 + " " * 300_000 + "y" * 300_000 + " "
    assert infilling.unit_ends(text) == [m.end() for m in UNIT.finditer(text)]


def _plain(text, key, how):
    text = text or ""
    digest = hashlib.sha256(f"{how.seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    n = len(units)
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= how.rate:
        return key, n, "plain", None, None, text, text
    a, b = min(h[0] % (n + 1), h[1] % (n + 1)), max(h[0] % (n + 1), h[1] % (n + 1))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < how.spm:
        return key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


@pytest.mark.parametrize("how", [infilling.Infilling(), infilling.Infilling(7, 100, 50), infilling.Infilling(1, 0, 0)])
def test_edges(spark, how):
    rows = [(i, t) for t in ODD for i in range(12)] + [(None, "a b c d"), (5, None), (5, "a b c d"), (5, "a b c d"), (-3, "below zero")]
    df = spark.createDataFrame([(*r, 9, "f", "o") for r in rows], "doc_id long, text string, n int, form string, output string").repartition(5)
    done = infilling.fill_in_middle(df, how)
    got = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in done.collect()]
    want = [_plain(t, k, how) for k, t in rows]
    assert sorted(got, key=str) == sorted((w[:6] for w in want), key=str)
    back = infilling.restored(done, how)
    assert back.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "restored"]
    assert sorted((str(r["doc_id"]), r["restored"]) for r in back.collect()) == sorted((str(w[0]), w[6]) for w in want)
    assert infilling.restored(infilling.fill_in_middle(df.limit(0), how), how).count() == 0


def test_bytes_that_are_no_utf8_come_back(spark):
    df = spark.sql("SELECT CAST(id AS BIGINT) AS doc_id, CAST(X'6120FF20C3286220' AS STRING) AS text FROM range(40)")
    done = infilling.restored(infilling.fill_in_middle(df))
    assert {bytes(r[0]) for r in done.selectExpr("CAST(restored AS BINARY)").collect()} == {bytes.fromhex("6120FF20C3286220")}


def test_markers_that_could_be_confused_are_refused():
    for markers in (("<P>", "<P>>", "<M>"), ("aa", "b", "c"), ("", "b", "c"), ("ab", "bc", "d")):
        with pytest.raises(ValueError, match="markers"):
            infilling.Infilling(1, 50, 50, *markers)
