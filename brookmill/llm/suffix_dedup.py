"""Suffix-array dedup by bucket-pointer refinement.

Text bytes are cut into segments that share a content key
(:mod:`brookmill.llm.windows`), so that equal windows meet in one shard of a few
MB. There the suffixes are sorted to the depth of a window: initial buckets of
q-grams, then each bucket is refined by the bucket pointers of the suffixes one
depth further on. A refined pointer is at once that of the next, twice as deep
step, so the updates are reused recursively.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from brookmill.llm.windows import Unit, packed_texts, repeated_windows, without_parts

Q = 8


def _first_buckets(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and bucket pointers by the first ``Q`` bytes (zeros behind the end)."""
    grams = np.zeros(len(data) + Q, np.uint64)
    grams[: len(data)] = data
    for span in (1, 2, 4):
        grams[:-span] = (grams[:-span] << np.uint64(8 * span)) | grams[span:]
    return _point(grams[: len(data)])


def _point(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``keys`` and, per key, the place where its bucket begins in that order."""
    order = np.argsort(keys)
    ranked = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))
    pointers = np.empty(len(keys), np.int64)
    pointers[order] = begin
    return order, pointers


def bucket_pointers(data: np.ndarray, depth: int) -> np.ndarray:
    """Bucket pointers of all suffixes by their first ``depth`` bytes.

    Two suffixes that have ``depth`` bytes have equal pointers exactly if these
    bytes are equal. Suffixes alone in their bucket are never sorted again.
    """
    if depth < Q:
        raise ValueError(f"depth is at least {Q}")
    order, pointers = _first_buckets(data)
    done = Q
    while done < depth and len(order):
        step = min(done, depth - done)
        here = pointers[order]
        crowded = np.zeros(len(order), bool)
        same = here[1:] == here[:-1]
        crowded[1:] |= same
        crowded[:-1] |= same
        order, here = order[crowded], here[crowded]
        if not len(order):
            break
        behind = order + step
        further = np.where(behind < len(data), pointers[np.minimum(behind, len(data) - 1)] + 1, 0)
        keys = here.astype(np.uint64) * np.uint64(len(data) + 1) + further.astype(np.uint64)
        sorting, local = _point(keys)
        start_of_bucket = np.maximum.accumulate(np.where(np.append(True, here[1:] != here[:-1]), np.arange(len(here)), 0))
        pointers[order] = here + local - start_of_bucket
        order = order[sorting]
        done += step
    return pointers


def earliest(contents: list[bytes], windows: np.ndarray, rank: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``contents`` the smallest rank among windows with equal bytes."""
    data = np.frombuffer(b"".join(contents), np.uint8)
    first = np.cumsum(windows + width - 1) - (windows + width - 1)
    starts = np.arange(len(rank)) + np.repeat(first - (np.cumsum(windows) - windows), windows)
    pointers = bucket_pointers(data, width)[starts]
    best = np.full(len(data), np.iinfo(np.int64).max)
    np.minimum.at(best, pointers, rank)
    return best[pointers]


def repeated_bytes(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = 100, crowd: int | None = None) -> DataFrame:
    """Return per row of ``df``: key, n_symbols (bytes), n_removed, spans, kept.

    Each byte covered by a ``width``-byte string that also starts earlier (at a
    smaller key, or in the same text at an earlier byte) is removed; overlaps
    count. ``spans`` are the maximal removed runs as (start, end), ``kept`` the
    remaining bytes. Null text counts as empty; a null key comes before all
    others; rows that repeat key and text are one text and get equal rows; rows
    that share a key and differ in text do not see each other as earlier except
    by their start. Other columns are not read. With ``crowd``, the
    segments of a key of more different contents are dealt by window: smaller
    tasks, the same results, and a shuffle of all windows of such keys.
    """
    unit = Unit(width, 16, words=False)
    packed = packed_texts(df, text, key)
    parts = repeated_windows(df, packed, unit, lambda c, n, r: earliest(c, n, r, width), text, key, other_texts_only=False, crowd=crowd)
    return without_parts(packed, unit, parts, key)
