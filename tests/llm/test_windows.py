"""Repeated words and bytes against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from brookmill.llm import queries, substring_dedup, suffix_dedup, windows
from tests.conftest import SMALL
from tests.llm import brute

SCHEMA = "doc_id long, text string, uid string, key int, hash string"


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_queries_equal_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op3_substring_dedup(spark, SMALL).collect()
    assert _sorted(got) == _sorted(brute.substring(rows, 50))
    got = queries.op10_suffix_dedup(spark, SMALL).collect()
    assert _sorted(got) == _sorted(brute.suffix(rows, 100))
    assert sum(r["n_removed"] for r in got) > 0


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(7)
    words = [f"w{i}é" for i in range(40)]
    shared = [" ".join(rng.choices(words, k=90)) for _ in range(4)]
    rows = [(None, shared[0]), (3, None), (4, ""), (5, " \t\n"), (6, "a " * 700), (7, "abc" * 400), (2, shared[0] + " \n" + shared[1])]
    for i in range(40):
        parts = [rng.choice([*shared, " ".join(rng.choices(words, k=rng.randint(1, 60)))]) for _ in range(4)]
        rows.append((10 + i, rng.choice(["  ", "\n", " "]).join(parts)))
    rows += [rows[10], rows[10], (8, "x " + "a " * 300), (9, "w" * 5000 + " " + shared[2])]
    rows += [(100 + i, shared[3]) for i in range(30)]
    return rows, spark.createDataFrame([(k, t, "u", 1, "h") for k, t in rows], SCHEMA).repartition(5)


def test_edges(odd):
    rows, df = odd
    got = substring_dedup.repeated_words(df, width=20).selectExpr("doc_id", "n_symbols", "n_removed", "sha2(kept, 256)").collect()
    assert _sorted(got) == _sorted(brute.substring(rows, 20))
    got = suffix_dedup.repeated_bytes(df, width=40).selectExpr("doc_id", "n_symbols", "n_removed", "size(spans)", "sha2(kept, 256)").collect()
    assert _sorted(got) == _sorted(brute.suffix(rows, 40))


@pytest.mark.parametrize("crowd", [1, 5])
def test_crowded_keys_are_cut_into_windows(odd, spark, crowd):
    """The results stay those of brute force, with nearly every key crowded and with few."""
    rows, df = odd
    rng = random.Random(21)
    words = [f"u{i}" for i in range(300)]
    passage = " ".join(rng.choices(words, k=45))
    more = [(1000 + i, " ".join([*rng.choices(words, k=30), passage, *rng.choices(words, k=30)])) for i in range(60)] + [(5000, "z " * 90 + passage)]
    rows = rows + more
    df = df.unionByName(spark.createDataFrame([(k, t, "u", 1, "h") for k, t in more], SCHEMA)).repartition(3)
    got = substring_dedup.repeated_words(df, width=20, crowd=crowd).selectExpr("doc_id", "n_symbols", "n_removed", "sha2(kept, 256)").collect()
    assert _sorted(got) == _sorted(brute.substring(rows, 20))
    got = suffix_dedup.repeated_bytes(df, width=40, crowd=crowd).selectExpr("doc_id", "n_symbols", "n_removed", "size(spans)", "sha2(kept, 256)").collect()
    assert _sorted(got) == _sorted(brute.suffix(rows, 40))


def test_windows_of_a_crowded_key_are_few(spark):
    """A passage in every text between other words: after the cut no key has more than a few different contents."""
    rng = random.Random(2)
    words = [f"u{i}" for i in range(2000)]
    passage = " ".join(rng.choices(words, k=60))
    rows = [(i, " ".join([*rng.choices(words, k=60), passage, *rng.choices(words, k=60)])) for i in range(400)]
    df = spark.createDataFrame([(k, t, "u", 1, "h") for k, t in rows], SCHEMA).repartition(4)
    unit = windows.Unit(50, 8, words=True)
    packed = windows.packed_texts(df, "text", "doc_id")
    refs = windows._rows(df, "text", "doc_id").select("doc", "mark", "text").mapInArrow(windows._deal(unit), windows._DEALT)
    whole = windows._meet(refs)
    largest = lambda shared: max(r["n"] for r in shared.filter("first").groupBy("key").agg(F.count("*").alias("n")).collect())
    assert largest(whole) > 300 > 25 > largest(windows._split_crowds(whole, packed, unit, 20))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.repeated_words(none).count() == 0
    assert suffix_dedup.repeated_bytes(none).count() == 0


def test_hot_contents_are_combined():
    unit = windows.Unit(20, 8, words=False)
    data = b"the same passage of text that stands everywhere " * 1
    texts = [data + bytes([65 + i]) * 3 for i in range(20)]
    edges = np.cumsum([0, *map(len, texts)])
    found = windows.segments(unit, np.frombuffer(b"".join(texts), np.uint8), edges)
    assert found["n"].sum() == sum(len(t) - 19 for t in texts)
    assert len(set(found["hash"].tolist())) < len(found["hash"]) / 3


def test_bucket_pointers_equal_windows():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[2000:2400] = data[100:500]
    pointers = suffix_dedup.bucket_pointers(data, 30)
    text, seen = data.tobytes(), {}
    for i in range(len(text) - 29):
        assert seen.setdefault(text[i : i + 30], pointers[i]) == pointers[i]
    assert len(set(seen.values())) == len(seen)


def test_backward_search_counts():
    rng = np.random.default_rng(5)
    text = np.append(rng.integers(1, 6, 500), 0)
    index = substring_dedup.FMIndex(text, 6, 8)
    for start in range(0, 480, 7):
        low, high = np.zeros(1, np.int64), np.full(1, len(text))
        for symbol in text[start : start + 4][::-1]:
            low, high = index.extend(np.array([symbol]), low, high)
        want = sum((text[i : i + 4] == text[start : start + 4]).all() for i in range(len(text) - 4))
        assert high[0] - low[0] == want


def _thue_morse(length, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(length))


@pytest.mark.parametrize("letters", ["ab", "xq", "09"])
def test_words_that_sums_modulo_two_to_64_mistake(spark, letters):
    """Such words have equal hashes modulo 2**64 for every base, yet repeat nowhere."""
    one, two = _thue_morse(1024, letters), _thue_morse(1024, letters[::-1])
    rows = [(1, " ".join([f"w{i}" for i in range(49)] + [one])), (2, " ".join([f"w{i}" for i in range(49)] + [two])), (3, one * 4), (4, two * 4), (5, one + two)]
    df = spark.createDataFrame([(k, t, "u", 1, "h") for k, t in rows], SCHEMA)
    got = substring_dedup.repeated_words(df).selectExpr("doc_id", "n_symbols", "n_removed", "sha2(kept, 256)").collect()
    assert _sorted(got) == _sorted(brute.substring(rows, 50)) and all(r["n_removed"] == 0 for r in got)
    got = suffix_dedup.repeated_bytes(df).selectExpr("doc_id", "n_symbols", "n_removed", "size(spans)", "sha2(kept, 256)").collect()
    assert _sorted(got) == _sorted(brute.suffix(rows, 100))


def test_content_hashes_equal_big_integers():
    rng = np.random.default_rng(9)
    prime, base = 2**61 - 1, windows._PRIME_POWERS.base
    for symbols in (rng.integers(1, 257, 3000).astype(np.uint64), rng.integers(1, prime - 1, 700).astype(np.uint64), rng.integers(1, 2**22, 9000).astype(np.uint64)):
        start = rng.integers(0, len(symbols), 60)
        end = np.minimum(start + rng.integers(0, len(symbols), 60), len(symbols))
        want = [sum(int(s) * pow(base, i, prime) for i, s in enumerate(symbols[a:b].tolist())) % prime for a, b in zip(start.tolist(), end.tolist())]
        assert windows.Content(symbols).ranges(start, end).tolist() == want


def test_texts_of_one_key_with_equal_low_hash_bits(spark):
    """Two texts under one key whose 64-bit hashes share the lower 24 bits, and thousands of rows without a key."""
    rng = random.Random(11)
    words = [f"v{i}" for i in range(3000)]
    shared = " ".join(words[:60])
    made = [shared + " " + " ".join(rng.choices(words, k=8)) if i % 2 else " ".join(rng.choices(words, k=70)) for i in range(16000)]
    hashed = spark.createDataFrame([(t,) for t in made], "text string").selectExpr("text", "xxhash64(text) & 16777215 AS low").collect()
    seen, pair = {}, None
    for t, low in hashed:
        other = seen.setdefault(low, t)
        if other != t and other.startswith(shared) != t.startswith(shared):
            pair = (other, t)
    assert pair is not None
    rows = [(1, shared)] + [(7, t) for t in pair] + [(None, t) for t in made[:5000:5] if t not in pair] + [(None, None)]
    df = spark.createDataFrame([(k, t, "u", 1, "h") for k, t in rows], SCHEMA)
    got = substring_dedup.repeated_words(df).selectExpr("doc_id", "n_symbols", "n_removed", "sha2(kept, 256)").collect()
    assert _sorted(got) == _sorted(brute.substring(rows, 50))
    assert sorted(r["n_removed"] > 0 for r in got if r["doc_id"] == 7) == [False, True]
