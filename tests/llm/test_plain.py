"""URL filter, token counts and exact dedup against SQL, the library and edges; the pipeline against brute force."""

from __future__ import annotations

import duckdb
import public_tokenizers
import pytest

from brookmill.llm import exact_dedup, queries, token_counts, url_filter
from tests.compare import connect
from tests.conftest import SMALL
from tests.llm.common import same_rows

BPE = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_sql(spark, name):
    same_rows(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLE_SQL[name])


def test_urls(spark):
    urls = ["HTTP://WWW.Example.COM/en/x?y#z", "https://example.com?q=/en/", "ftp://a.net/es/", "x://net/fr/#", "no scheme", None, "", "a://", "a://b://c/d", "m://xexample.com/en/1", "u://bad.org/p", "u://bad.org/q", "u://good.org/", "u://h\n.org/a\nb"]
    pages = [(i, u, "k") for i, u in enumerate(urls)] + [(None, "u://bad.org/r", "k"), (100, "u://bad.org/1", "k")] + [(200 + i, f"u://w{i % 3}.bad.org/", "k") for i in range(60)]
    labels = [(i, 0) for i in (10, 11, 100, *range(200, 255))] + [(12, 1), (None, 1), (0, None), (10, 0), *((i, 1) for i in range(3000, 3005))]
    page_frame = spark.createDataFrame(pages, "page_id long, url string, host string").repartition(3)
    label_frame = spark.createDataFrame(labels, "doc_id long, quality int")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, host VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER)")
    con.executemany("INSERT INTO labels VALUES (?, ?)", labels)
    done = url_filter.url_verdicts(page_frame, label_frame, url_filter.RULES)
    same_rows(done, con, url_filter.SQL)
    got = {r["page_id"]: r for r in done.collect()}
    assert (got[0]["host"], got[0]["path"], got[0]["rule"], got[0]["verdict"]) == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert (got[1]["host"], got[1]["path"], got[1]["rule"]) == ("example.com", "", None)
    assert (got[8]["host"], got[8]["path"]) == ("b:", "//c/d") and got[9]["rule"] == "com/"
    assert got[10]["verdict"] == "block" and got[200]["verdict"] == "block" and got[12]["verdict"] == "allow"
    assert url_filter.url_verdicts(page_frame, label_frame.limit(0)).filter("verdict = 'block'").count() == 0
    assert url_filter.url_verdicts(page_frame.limit(0), label_frame).count() == 0


def test_token_counts_equal_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    odd = ["", " ", "a  b", "it's\n\n  x <|endoftext|> y<|endoftext|>", "é😀" * 3000, "word " * 40000, " \t " * 9000, "x" * 70000, "a " + " b" * 20000 + "  c'll 12 345", None]
    rows = [(i, t) for i, t in enumerate(odd)] + [(None, "a b"), (1, " ")] + [(100 + r[0], r[1]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int").repartition(3)
    want = sorted((str(k), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False)), len(library.encode(t or "", add_special_tokens=False)) > 512) for k, t in rows)
    got = sorted((str(r[0]), *r[1:]) for r in token_counts.token_counts(df, BPE).collect())
    assert got == want
    assert token_counts.token_counts(df.limit(0), BPE).count() == 0


def test_batches_hold_about_as_many_bytes(monkeypatch):
    """Texts of two-byte characters fill a batch with half as many characters."""
    seen = []

    class Library:
        def encode_batch_fast(self, pieces, add_special_tokens):
            seen.append(sum(len(p.encode()) for p in pieces))
            return [[0]] * len(pieces)

    monkeypatch.setattr(token_counts, "_tokenizer", lambda path: Library())
    assert token_counts.count_texts(["é" * 300] * 40 + ["e" * 600] * 40 + ["x " * 40000], "", 6000) == [1] * 80 + [3]
    assert all(b <= 6600 for b in seen[:8]) and sum(seen) == 80 * 600 + 80000


def test_split_safely_keeps_everything():
    text = "ab cd  ef gh " * 500 + "x" * 100
    parts = token_counts.split_safely(text, 64)
    assert "".join(parts) == text and len(parts) > 50
    assert all(p[0] == " " and p[1] != " " for p in parts[1:])


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_edges(spark, keep):
    rows = [(1, "Abc"), (2, "aBC"), (3, None), (4, ""), (5, "É"), (6, "é"), (None, "abc"), (7, "x" * 100000), (8, "X" * 100000), (9, "dup"), (9, "dup"), (None, "only null"), (None, "only null")]
    rows += [(100 + i, "hot text") for i in range(300)]
    df = spark.createDataFrame([(*r, "d", True) for r in rows], "doc_id long, text string, digest string, kept boolean").repartition(5)
    got = exact_dedup.content_sort(df, keep=keep).collect()
    assert len(got) == len(rows)
    kept = sorted((r["text_sha256"], str(r["doc_id"])) for r in got if r["kept"])
    assert len({k for k, _ in kept}) == len(kept) == 8
    by = {r["doc_id"]: r for r in got}
    assert by[150]["group_size"] == 300 and by[150]["keep_id"] == (399 if keep == "largest" else 100)
    assert by[1]["keep_id"] == (2 if keep == "largest" else 1) and by[3]["group_size"] == 2
    assert by[None]["keep_id"] in ((2, None) if keep == "largest" else (1, None))
    whole = exact_dedup.keep_first_copies(df, keep=keep)
    assert whole.columns == df.columns and whole.count() == 8
    assert exact_dedup.content_sort(df.limit(0), keep=keep).count() == 0


def test_selected_rows_keep_columns_of_any_name(spark):
    from brookmill.llm import minhash, tiling

    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words, 10, "x", 1.5, "a"), (2, words, 11, "y", 2.5, "b"), (3, "other words stand here now and on", 12, None, 3.5, "c"), (3, "other words stand here now and on", 13, None, 3.5, "c")]
    odd = ["doc_id", "text", "__row_id", "a.b", "row_hash", "back`tick"]
    df = spark.createDataFrame(rows, "doc_id long, text string, c1 long, c2 string, c3 double, c4 string").toDF(*odd)
    benchmark = spark.createDataFrame([(5, " ".join(f"b{i}" for i in range(30)))], "item_id long, text string")
    for done, want in (
        (exact_dedup.keep_first_copies(df), {1, 3}),
        (minhash.keep_one_of_each(df), {1, 3}),
        (tiling.without_contaminated(df, benchmark), {1, 2, 3}),
    ):
        got = [tuple(r) for r in done.collect()]
        assert done.columns == odd and {r[0] for r in got} == want and set(got) <= set(rows)
    assert len(tiling.without_contaminated(df, benchmark).collect()) == 4


def test_ties_of_one_key_go_by_text_then_row_hash(spark):
    rows = [(1, "aA b", "p"), (1, "Aa b", "q"), (1, "Aa b", "r"), (2, None, "s"), (2, "", "t")]
    got = set()
    for parts in (1, 2, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string, extra string").repartition(parts)
        got.add(tuple(sorted(((r[0], r[1], r[2]) for r in exact_dedup.keep_first_copies(df).collect()), key=str)))
    assert len(got) == 1
    (only,) = got
    assert [(r[0], r[1]) for r in only] == [(1, "Aa b"), (2, None)]
