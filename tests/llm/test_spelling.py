"""Spelling variants against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from brookmill.llm import queries, spelling
from tests.conftest import SMALL
from tests.llm import brute_words as brute

SCHEMA = "doc_id long, text string, word int, n string, size string"


def _by_word(rows):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}


def test_query_equals_brute_force(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    done = queries.op11_spelling(spark, SMALL)
    assert done.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = done.collect()
    assert _by_word(got) == brute.variants(brute.counts(docs, 6, 5, 199), 5) and len(got) == len(_by_word(got)) > 100


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_few_letters_and_repeated_bigrams(spark, seed):
    """Words over few letters share most bigrams; many hold the same one several times."""
    rng = random.Random(seed)
    made = {"".join(rng.choices("abÀ", weights=[6, 2, 1], k=rng.randint(4, 9))) for _ in range(700)} | {"a" * k for k in range(4, 12)}
    words = {w: rng.choice([1, 1, 2, 5, 10, 60, 300, 1500]) for w in made}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    want = {(a, b) for a in words for b in words if brute.one_edit(a, b)}
    got = [(r["word"], r["other"], r["n"], r["other_n"]) for r in spelling.links(frame).collect()]
    assert {g[:2] for g in got} == want and len(got) == len(want) > 2000
    assert all(words[a] == x and words[b] == y for a, b, x, y in got)


def test_edges(spark):
    rows = [(1, "Colour colour COLOUR"), (2, None), (3, ""), (None, "colour, colour! " * 20 + "color colours"), (4, "Éclairs éclairs " * 3), (4, "x" * 70000), (5, "ab abc"), (5, "strasse×straße " * 9)]
    rows += [(10 + i, "colour kolour " * 30) for i in range(50)] + [(7, "kolours " * 3)] * 3
    df = spark.createDataFrame([(*r, 1, "n", "s") for r in rows], SCHEMA).repartition(4)
    got = spelling.spelling_variants(df, least_count=2, one_in=3).collect()
    assert _by_word(got) == brute.variants(brute.counts(rows, 6, 2, 3), 5)
    plain = _by_word(spelling.spelling_variants(df, least_count=1, one_in=0, times=2).collect())
    assert plain == brute.variants(brute.counts(rows, 6, 1, 0), 2)
    assert spelling.spelling_variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="four characters"):
        spelling.spelling_variants(df, least_length=3)


def test_chain_of_forms_ends_at_its_root(spark):
    chain = ["abcdef", "abcdeg", "abcdhg", "abcihg", "abjihg", "akjihg"]
    rows = [(1, (w + " ") * (2 * 5**i)) for i, w in enumerate(chain)]
    got = _by_word(spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), least_count=2, one_in=0).collect())
    assert {w: got[w][4] for w in chain} == dict.fromkeys(chain, "akjihg")
    assert got["akjihg"][2] is None and got["abcdef"][2:4] == ("abcdeg", 10)


def test_pivots_are_two_disjoint_bigrams_of_the_prefix_in_the_fewest_words(spark):
    rng = random.Random(5)
    words = list({"".join(rng.choices("abcd", k=rng.randint(4, 8))) for _ in range(200)})
    rows = spelling.pivotal_grams(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    held = {}
    for w in words:
        for g in {w[i : i + 2] for i in range(len(w) - 1)}:
            held[g] = held.get(g, 0) + 1
    for r in rows:
        w = r["word"]
        first = sorted((held[w[i : i + 2]], w[i : i + 2], i + 1) for i in range(len(w) - 1))[:3]
        least = min(a[0] + b[0] for a in first for b in first if b[2] - a[2] >= 2)
        one, two = (tuple(p) for p in r["pivots"])
        assert {one, two} <= set(first) and abs(one[2] - two[2]) >= 2 and one[0] + two[0] == least


def test_deletion_is_by_code_points(spark):
    row = spark.createDataFrame([("Àbcdé", 5)], "w string, k long").select(spelling.planted(F.col("w"), F.col("k"), 1)).first()
    assert len(row[0]) == 4 and row[0] in {"bcdé", "Àcdé", "Àbdé", "Àbcé", "Àbcd"}
