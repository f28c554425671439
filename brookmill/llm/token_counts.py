"""Token counts: batch encoding inside Arrow functions that return lengths only."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmill.llm.windows import slices

BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 15
#: A single space between two characters that are not white space. The byte-level pattern always starts a token at such
#: a space, and its look-ahead never reaches over it, so the two sides are tokenised as in the whole text.
_BORDER = re.compile(r"(?<=\S) (?=\S)")


def split_safely(text: str, size: int = PIECE_CHARS) -> list[str]:
    """Cut a long text into pieces of about ``size`` characters at safe borders only.

    A stretch without a safe border stays whole.
    """
    pieces, start = [], 0
    while len(text) - start > size:
        border = _BORDER.search(text, start + size)
        if border is None:
            break
        pieces.append(text[start : border.start()])
        start = border.start()
    pieces.append(text[start:])
    return pieces


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def count_texts(texts: list[str], path: str, batch_bytes: int = BATCH_BYTES) -> list[int]:
    """Token counts of ``texts``, encoded in batches of about ``batch_bytes`` bytes."""
    encode = _tokenizer(path).encode_batch_fast
    counts = [0] * len(texts)
    owners: list[int] = []
    pieces: list[str] = []
    held = 0

    def flush() -> None:
        nonlocal held
        for owner, encoded in zip(owners, encode(pieces, add_special_tokens=False), strict=True):
            counts[owner] += len(encoded)
        owners.clear()
        pieces.clear()
        held = 0

    for i, text in enumerate(texts):
        for piece in split_safely(text):
            owners.append(i)
            pieces.append(piece)
            held += len(piece) if piece.isascii() else len(piece.encode())
            if held >= batch_bytes:
                flush()
    if pieces:
        flush()
    return counts


def token_counts(df: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", limit: int = 512) -> DataFrame:
    """Return per row: key, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    ``tokenizer`` is the path of a byte-level BPE file of the ``tokenizers``
    library, readable on every executor. Special strings inside a text are
    handled as by the library's default; no special token is added. Null text
    counts as empty; keys are passed on as they are; other columns are not
    read. Texts are handed over about ``BATCH_BYTES`` bytes at a time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, BATCH_BYTES):
                counts = count_texts(part.column(1).to_pylist(), tokenizer)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(counts, pa.int64())], ["key", "n_bytes", "n_tokens"])

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key).alias("key"), whole.alias("text"), F.octet_length(whole).cast("long").alias("n_bytes"))
    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
