"""Substring dedup with a compressed FM-index per shard.

Texts are cut into segments of words that share a content key
(:mod:`brookmill.llm.windows`), so equal windows meet in one shard. A shard's
index is the Burrows-Wheeler transform of its words in a wavelet matrix of
packed bits. The segments are then streamed through it: backward search extends
every match to the left word by word, all windows at a time, and reports the
interval where the matching statistic reaches the threshold.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from brookmill.llm.windows import CROWD, Unit, packed_texts, repeated_windows, without_parts


class PackedBits:
    """A bit vector in 64-bit words with counts of ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int32)
        self.before[1:] = np.cumsum(np.bitwise_count(self.words[:-1]))
        self.zeros = len(bits) - int(np.bitwise_count(self.words).sum())

    def ones_before(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FMIndex:
    """Backward search over a text of symbols 0 .. size-1."""

    def __init__(self, text: np.ndarray, size: int, depth: int) -> None:
        self.order = suffix_order(text, depth)
        transform = text[self.order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self.levels = []
        for bit in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bits = ((transform >> bit) & 1).astype(np.uint8)
            self.levels.append((bit, PackedBits(bits)))
            transform = np.concatenate([transform[bits == 0], transform[bits == 1]])

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of suffixes that begin with ``symbol`` and go on as in [low, high)."""
        begin = np.zeros(len(symbol), np.int64)
        for bit, packed in self.levels:
            one = ((symbol >> bit) & 1) == 1
            places = np.concatenate([begin, low, high])
            ones = packed.ones_before(places)
            ones = np.where(np.concatenate([one] * 3), packed.zeros + ones, places - ones)
            begin, low, high = np.split(ones, 3)
        start = self.first[symbol] - begin
        return start + low, start + high


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols or more, cyclic.

    That order serves backward search of patterns up to ``depth`` symbols.
    """
    rank = text.astype(np.int64)
    done, order = 1, np.argsort(rank, kind="stable")
    while done < depth:
        keys = rank * (int(rank.max()) + 1) + np.roll(rank, -done)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        fresh = np.zeros(len(text), np.int64)
        fresh[1:] = ranked[1:] != ranked[:-1]
        rank = np.empty(len(text), np.int64)
        rank[order] = np.cumsum(fresh)
        done *= 2
        if fresh.sum() == len(text) - 1:
            break
    return order


def matches(index: FMIndex, text: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stream the windows at ``starts`` through the index.

    Returns the windows whose matching statistic reaches ``width`` with at least
    two occurrences, and their intervals. A window whose interval narrows to its
    own occurrence is left at once.
    """
    alive = np.arange(len(starts))
    low = np.zeros(len(starts), np.int64)
    high = np.full(len(starts), len(text), np.int64)
    for step in range(width - 1, -1, -1):
        low, high = index.extend(text[starts[alive] + step], low, high)
        more = high - low > 1
        alive, low, high = alive[more], low[more], high[more]
        if not len(alive):
            break
    return alive, low, high


def earliest(contents: list[bytes], windows: np.ndarray, rank: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``contents`` the smallest rank among windows with equal words."""
    words = [c.split(b" ") for c in contents]
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number) + 1) for text in words for w in (*text, b"")]
    text = np.array(ids, np.int64)
    text[np.cumsum([len(w) + 1 for w in words]) - 1] = 0
    first = np.cumsum(windows + width) - (windows + width)
    starts = np.arange(len(rank)) + np.repeat(first - (np.cumsum(windows) - windows), windows)
    index = FMIndex(text, len(number) + 1, width)
    found, low, high = matches(index, text, starts, width)
    best = rank.copy()
    if len(found):
        by_suffix = np.full(len(text), np.iinfo(np.int64).max)
        by_suffix[starts] = rank
        by_suffix = by_suffix[index.order]
        _, one, back = np.unique(low, return_index=True, return_inverse=True)
        length = high[one] - low[one]
        edges = np.cumsum(length) - length
        members = np.arange(length.sum()) + np.repeat(low[one] - edges, length)
        best[found] = np.minimum.reduceat(by_suffix[members], edges)[back]
    return best


def repeated_words(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = 50, crowd: int = CROWD) -> DataFrame:
    """Return per row of ``df``: key, n_symbols (words), n_removed, spans, kept.

    Words are runs of characters other than space and \\t-\\r, unchanged. Each
    word covered by a window of ``width`` words that also starts in a text with
    a smaller key is removed. ``spans`` are the maximal removed runs of words,
    ``kept`` the other words joined by one space, in UTF-8. Null text counts as
    empty; a null key comes before all others; texts with equal keys do not
    count as earlier than each other; repeated rows get equal rows. Other
    columns are not read. ``crowd`` is the number of different contents of one
    key from which they are dealt by window; results are the same at any.
    """
    unit = Unit(width, 8, words=True)
    packed = packed_texts(df, text, key)
    parts = repeated_windows(df, packed, unit, lambda c, n, r: earliest(c, n, r, width), text, key, other_texts_only=True, crowd=crowd)
    return without_parts(packed, unit, parts, key)
