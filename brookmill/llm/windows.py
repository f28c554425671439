"""Repeated windows of a fixed number of symbols, found without comparing every window with every other.

A window is ``width`` consecutive symbols (bytes or words) of one text. Its key
is the smallest hash among its ``gram``-symbol substrings, so equal windows have
equal keys wherever they stand. Runs of neighbouring windows with one key form a
segment, one row of numbers for every few dozen symbols:

1. every text is cut into segments (key, content hash, place), without its text;
2. rows are dealt by key; a key met once drops out, unless its segment may hold
   equal windows itself; of equal contents the earliest place represents all. Contents met often within one batch are
   combined before the shuffle: one occurrence takes part, the others wait
   under keys of their own, so no key holds more than a few rows per batch;
   The segments of a key with too many different contents are cut into windows first;
3. only representatives fetch their text, and go to shards by key. A shard is
   a few MB; how many there are follows from the data;
4. in each shard an index (the caller's) finds for each window the earliest
   equal one; runs of windows come back per content;
5. every occurrence of a content takes those runs that begin earlier than
   itself, and each text gets the list of its covered parts.

Texts move once, packed, for steps 3 and 5; otherwise numbers move. Order is by (key column,
start); a null key column comes before all others.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmill.scratch import cut

SLICE_BYTES = 1 << 20
SHARD_BYTES = 2 << 20
#: A segment is cut after so many windows; only periodic text gets there.
MOST_WINDOWS = 200
#: Different contents of one key from which its segments are cut into single windows.
CROWD = 20_000
#: Equal contents within one slice from which they are combined.
OFTEN = 4
#: Places of one slice that fit below the upper bits of a hash.
_PLACES = 1 << 26
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_HASH = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


#: The modulus of content hashes, a Mersenne prime.
_P = 2**61 - 1
_PRIME, _HALF, _REST = np.uint64(_P), np.uint64(2**31 - 1), np.uint64(2**30 - 1)


def _fold(x: np.ndarray) -> np.ndarray:
    """``x`` modulo 2**61 - 1."""
    x = (x & _PRIME) + (x >> np.uint64(61))
    return np.minimum(x, x - _PRIME)  # the difference wraps around to a large number where x is smaller


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2**61 - 1 of numbers below it."""
    a1, a0, b1, b0 = a >> np.uint64(31), a & _HALF, b >> np.uint64(31), b & _HALF
    middle = a1 * b0 + a0 * b1
    return _fold((a1 * b1 << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & _REST) << np.uint64(31)) + a0 * b0)


class _PrimePowers:
    """Powers of a base and of its inverse modulo 2**61 - 1."""

    def __init__(self) -> None:
        self.base = int(np.random.default_rng(20240301).integers(2**40, _P - 1))
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            for name, base in (("up", self.base), ("down", pow(self.base, -1, _P))):
                known = getattr(self, name)
                setattr(self, name, np.concatenate([known, _times(known, np.full(len(known), pow(base, len(known), _P), np.uint64))]))
        return self.up[:n], self.down[:n]


_PRIME_POWERS = _PrimePowers()


class Content:
    """Hashes of ranges of any length of a symbol array, modulo 2**61 - 1.

    Symbols are 1 to 2**61 - 2. Modulo a prime, unequal ranges of n symbols have
    equal hashes for n bases of 2**61 at most; modulo a power of two some do for
    every base (:class:`Sums`).
    """

    def __init__(self, symbols: np.ndarray) -> None:
        up, self.down = _PRIME_POWERS.get(len(symbols) + 1)
        up = up[:-1]
        if len(symbols) and int(symbols.max()) * len(symbols) < 2**33:
            low, high = symbols * (up & _HALF), symbols * (up >> np.uint64(31))
        else:
            terms = _times(symbols, up)
            low, high = terms & _HALF, terms >> np.uint64(31)
        self.low, self.high = (np.append(np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)) for x in (low, high))

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        low, high = _fold(self.low[end] - self.low[start]), _fold(self.high[end] - self.high[start])
        high = ((high & _REST) << np.uint64(31)) + (high >> np.uint64(30))
        return _times(_fold(low + high), self.down[start])


class Sums:
    """Keys of short ranges of a symbol array, from running sums modulo 2**64.

    Quick, but long ranges with equal sums can be made for any base; what must
    not mistake one content for another takes :class:`Content`.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        up, self.down = _POWERS.get(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[:-1], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def grams(self, k: int) -> np.ndarray:
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[: len(self.sums) - k])


def sliding_min(a: np.ndarray, m: int) -> np.ndarray:
    """Smallest of each ``m`` neighbours."""
    span = 1
    while span * 2 <= m:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    return np.minimum(a[: len(a) - (m - span)], a[m - span :]) if m > span else a


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


def words_of(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of each word of concatenated texts, and the word count before each text edge."""
    solid = ~is_space(data)
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    inner = edges[:-1][edges[:-1] < len(data)]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    last = edges[1:][edges[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, edges)


def word_symbols(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Odd 64-bit hashes of the words between ``starts`` and ``ends``."""
    return mix(Content(data.astype(np.uint64) + np.uint64(1)).ranges(starts, ends)) | np.uint64(1)


@dataclass(frozen=True)
class Unit:
    """What a window counts: bytes, or words between white space."""

    width: int
    gram: int
    words: bool

    def symbols(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64-bit symbols of concatenated texts, and the edges of the texts in symbols."""
        if not self.words:
            return _BYTE_HASH[data], edges
        starts, ends, word_edges = words_of(data, edges)
        return word_symbols(data, starts, ends), word_edges

    def hashed(self, symbols: np.ndarray, data: np.ndarray) -> Content:
        """Hashes of ranges of symbols that tell contents apart."""
        return Content(_fold((symbols >> np.uint64(3)) | np.uint64(1)) if self.words else data.astype(np.uint64) + np.uint64(1))

    def content(self, text: bytes, places: list[tuple[int, int]]) -> list[bytes]:
        """The symbols from each (start, windows), words joined by one space."""
        if not self.words:
            return [text[s : s + n + self.width - 1] for s, n in places]
        words = text.translate(_TO_SPACE).split()
        return [b" ".join(words[s : s + n + self.width - 1]) for s, n in places]


_TO_SPACE = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and edges of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[edges[0] : edges[-1]] if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data, edges - edges[0]


def slices(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose binary ``column`` holds about ``size`` bytes; one text is never cut."""
    _, edges = texts_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(edges, edges[at] + size, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def segments(unit: Unit, data: np.ndarray, edges: np.ndarray) -> dict[str, np.ndarray]:
    """Key, content hash, text number, first window and number of windows of each segment, and whether it can repeat itself."""
    symbols, edges = unit.symbols(data, edges)
    n = len(symbols) - unit.width + 1
    counts = np.maximum(np.diff(edges) - unit.width + 1, 0)
    if n <= 0 or not counts.any():
        return {"key": np.zeros(0, np.uint64), "hash": np.zeros(0, np.uint64), "text": np.zeros(0, np.int64), "start": np.zeros(0, np.int64), "n": np.zeros(0, np.int64), "again": np.zeros(0, bool)}
    sums = Sums(symbols)
    keys = sliding_min(sums.grams(unit.gram), unit.width - unit.gram + 1)
    valid = np.zeros(len(symbols) + 1, np.int8)
    full = counts > 0
    np.add.at(valid, edges[:-1][full], 1)
    np.add.at(valid, edges[:-1][full] + counts[full], -1)
    valid = np.cumsum(valid[:n], dtype=np.int8) > 0
    first = valid.copy()
    first[1:] &= (keys[1:] != keys[:-1]) | ~valid[:-1]
    first[edges[:-1][full]] = True
    starts = np.flatnonzero(first)
    text = np.searchsorted(edges, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], n), edges[text] + counts[text])
    pieces = -(-(ends - starts) // MOST_WINDOWS)
    if (pieces > 1).any():
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, ends, text = np.repeat(starts, pieces) + number * MOST_WINDOWS, np.repeat(ends, pieces), np.repeat(text, pieces)
        ends = np.minimum(ends, starts + MOST_WINDOWS)
    runs = ends - starts
    hashes = mix(unit.hashed(symbols, data).ranges(starts, ends + unit.width - 1) + (runs.astype(np.uint64) << np.uint64(61)))
    again = repeats_key(sums.grams(unit.gram), keys, starts, ends)
    return {"key": keys[starts], "hash": hashes, "text": text, "start": starts - edges[text], "n": runs, "again": again}


def repeats_key(grams: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the gram that gives a segment its key stands in it more than once.

    Only such a segment can hold two equal windows. A gram gives some window
    its key exactly if it equals the largest key of the windows around it; these
    grams are sorted by (upper hash bits, place), where two neighbours within
    reach of one segment are found by binary search.
    """
    m = len(grams) - len(keys) + 1
    if len(grams) >= _PLACES:
        return np.ones(len(starts), bool)
    around = np.zeros(len(keys) + 2 * (m - 1), np.uint64)
    around[m - 1 : m - 1 + len(keys)] = keys
    tops = np.flatnonzero(~sliding_min(~around, m) == grams)
    upper = np.uint64(2**64 - _PLACES)
    sorted_tops = np.sort((grams[tops] & upper) | tops.astype(np.uint64))
    key = keys[starts] & upper
    second = np.searchsorted(sorted_tops, key | starts.astype(np.uint64)) + 1
    padded = np.append(sorted_tops, np.full(2, 2**64 - 1, np.uint64))
    return padded[second] <= (key | (ends + m - 2).astype(np.uint64))


def pack(data: bytes) -> bytes:
    """Compressed bytes with their size in front."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


#: Bits of ``place``: first window, number of windows, and whether the row stays in any case.
_START, _COUNT, _STAY = 9, 1, 0


_DEALT = "grp long, key long, hash long, doc long, mark long, place long"


def _dealt(key: np.ndarray, content: np.ndarray, doc: np.ndarray, mark: np.ndarray, start: np.ndarray, n: np.ndarray, again: np.ndarray) -> pa.RecordBatch:
    """Segment rows; of contents that are frequent among them the first occurrence speaks for the others."""
    order = np.lexsort((mark, start, doc, content, key))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1])
    group = np.cumsum(fresh) - 1
    often = np.empty(len(order), bool)
    extra = np.empty(len(order), bool)
    often[order] = np.bincount(group)[group] >= OFTEN
    extra[order] = ~fresh
    extra &= often
    place = start << _START | n << _COUNT | (often | again).astype(np.int64) << _STAY
    apart = np.where(extra, mix(content + mix(doc.astype(np.uint64) + mix(place.astype(np.uint64) + mix(mark.astype(np.uint64))))), key)
    return pa.RecordBatch.from_arrays(
        [pa.array(apart.view(np.int64)), pa.array(key.view(np.int64), mask=~extra), pa.array(content.view(np.int64)), pa.array(doc), pa.array(mark), pa.array(place)],
        ["grp", "key", "hash", "doc", "mark", "place"],
    )


def _deal(unit: Unit):
    """Arrow function from (doc, mark, text) to segment rows (grp, key, hash, doc, mark, place).

    ``key`` is set where ``grp`` is not the key itself, on occurrences of a
    content that is frequent in the slice; the first occurrence speaks for them.
    """

    def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                found = segments(unit, *texts_of(part.column(2)))
                if not len(found["key"]):
                    continue
                doc, mark = (part.column(i).to_numpy()[found["text"]] for i in (0, 1))
                yield _dealt(found["key"], found["hash"], doc, mark, found["start"], found["n"], found["again"])

    return cut_texts


def _deal_windows(unit: Unit):
    """Arrow function from (doc, mark, places, packed text) to a row for each window of the given segments, its hash as key."""

    def cut_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                held = []
                for row in range(some.num_rows):
                    data = np.frombuffer(unpack(some.column(3)[row].as_py()), np.uint8)
                    symbols, _ = unit.symbols(data, np.array([0, len(data)]))
                    places = some.column(2)[row].values.to_numpy()
                    first, n = places >> _START, places >> _COUNT & 0xFF
                    starts = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    hashes = mix(unit.hashed(symbols, data).ranges(starts, starts + unit.width))
                    held.append((hashes, np.full(len(starts), row), starts))
                content, row, start = (np.concatenate(c) for c in zip(*held, strict=True))
                doc, mark = (some.column(i).to_numpy()[row] for i in (0, 1))
                yield _dealt(mix(content + np.uint64(_BASE)), content, doc, mark, start, np.ones(len(start), np.int64), np.zeros(len(start), bool))

    return cut_places


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the last column by its packed form, as texts take most of the room on their way."""
    for batch in batches:
        for some in slices(batch, batch.num_columns - 1, 8 * SLICE_BYTES):
            packed = pa.array([pack(x.as_py()) for x in some.columns[-1]], pa.binary())
            yield pa.RecordBatch.from_arrays([*some.columns[:-1], packed], names=batch.schema.names)


def _fetch(unit: Unit, shards: int):
    """Arrow function from (doc, places, packed text, key) to parcels (shard, parcel) of representatives with their content."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, list[bytes]]] = []
        size = 0

        def parcels() -> pa.RecordBatch:
            numbers = np.concatenate([h[0] for h in held], axis=1)
            contents = [c for h in held for c in h[1]]
            shard = numbers[0].view(np.uint64) % np.uint64(shards)
            order = np.argsort(shard, kind="stable")
            edges = np.append(np.flatnonzero(np.append(True, np.diff(shard[order]) != 0)), len(order))
            packed = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                some = order[a:b]
                head = np.append(numbers[:, some], [[len(contents[i]) for i in some]], axis=0)
                packed.append(pack(len(some).to_bytes(8, "little") + head.astype(np.int64).tobytes() + b"".join(contents[i] for i in some)))
            return pa.RecordBatch.from_arrays([pa.array(shard[order[edges[:-1]]].astype(np.int64)), pa.array(packed, pa.binary())], ["shard", "parcel"])

        for batch in batches:
            for row in np.flatnonzero(batch.column(1).is_valid().to_numpy(False)).tolist():
                key, content, place = (c.to_numpy() for c in batch.column(1)[row].values.flatten())
                start, n = place >> _START, place >> _COUNT & 0xFF
                found = unit.content(unpack(batch.column(2)[row].as_py()), list(zip(start.tolist(), n.tolist(), strict=True)))
                held.append((np.stack([key, content, np.full(len(key), batch.column(0)[row].as_py()), start, n]), found))
                size += sum(map(len, found))
                if size >= 16 * SLICE_BYTES:
                    yield parcels()
                    held.clear()
                    size = 0
        if held:
            yield parcels()

    return fetch


def _open(parcel: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Numbers (key, hash, doc, start, n) and contents of a parcel."""
    data = unpack(parcel)
    count = int.from_bytes(data[:8], "little")
    head = np.frombuffer(data, np.int64, 6 * count, 8).reshape(6, count)
    ends = (8 + 48 * count + np.cumsum(head[5])).tolist()
    return head[:5], [data[a:b] for a, b in zip([8 + 48 * count, *ends], ends)]


Index = Callable[[list[bytes], np.ndarray, np.ndarray], np.ndarray]


def _runs(index: Index):
    """Arrow function for one shard: for each content the runs of windows and the earliest place of each run.

    ``index`` gets the contents, their numbers of windows and the rank of each
    window's place; it returns the smallest rank among equal windows.
    """

    def solve(shard: pa.Table) -> pa.Table:
        opened = [_open(p.as_py()) for p in shard["parcel"]]
        key, content, doc, start, n = np.concatenate([numbers for numbers, _ in opened], axis=1)
        owner = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        doc, start = doc[owner], start[owner] + offset
        by_place = np.lexsort((start, doc))
        rank = np.empty(len(owner), np.int64)
        rank[by_place] = np.arange(len(owner))
        best = by_place[index([c for _, contents in opened for c in contents], n, rank)]
        doc, start = doc[best], start[best]
        fresh = np.ones(len(owner), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
        begin = np.flatnonzero(fresh)
        length = np.diff(np.append(begin, len(owner)))
        runs = pa.StructArray.from_arrays(
            [pa.array(offset[begin].astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(doc[begin]), pa.array(start[begin])], ["at", "n", "doc", "start"]
        )
        edges = np.searchsorted(owner[begin], np.arange(len(n) + 1)).astype(np.int32)
        return pa.table({"key": key, "hash": content, "runs": pa.ListArray.from_arrays(pa.array(edges), runs)})

    return solve


def packed_texts(df: DataFrame, text: str, key: str) -> DataFrame:
    """Return (doc, mark, key, packed): the order of a text, its hash, its key and its packed bytes.

    Rows that repeat key and text share (doc, mark) and are judged alike; the
    mark tells texts of one key apart.
    """
    rows = _rows(df, text, key).select("doc", "mark", "key", "text")
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(_compress, f"doc long, mark long, key {kind}, text binary").withColumnRenamed("text", "packed")


def _rows(df: DataFrame, text: str, key: str) -> DataFrame:
    return df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64(F.col(text)).alias("mark"),
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )


def _meet(refs: DataFrame) -> DataFrame:
    """(key, hash, doc, mark, place, first) of the segments that can repeat, stored; ``first`` marks one of each content."""
    same_key = Window.partitionBy("grp").orderBy("hash", "doc", "place", "mark")
    marked = refs.withColumn("before", F.lag("hash").over(same_key)).withColumn("after", F.lead("hash").over(same_key))
    extra, stay = F.col("key").isNotNull(), F.col("place").bitwiseAND(F.lit(1 << _STAY)) != 0
    marked = marked.filter(extra | stay | F.col("before").isNotNull() | F.col("after").isNotNull())
    first = ~extra & (F.col("before").isNull() | (F.col("before") != F.col("hash")))
    return cut(marked.select(F.coalesce("key", "grp").alias("key"), "hash", "doc", "mark", "place", first.alias("first")), "shared-windows")


def _split_crowds(shared: DataFrame, packed: DataFrame, unit: Unit, crowd: int) -> DataFrame:
    """``shared`` with the segments of every key that more than ``crowd`` different contents have cut into single windows.

    A passage that stands in very many texts, each time between other words,
    makes such a key. Its windows get keys of their own, by their whole content:
    those that hold other words stand alone and drop out, the others are one
    content each. Only texts that hold such a key are fetched for it.
    """
    crowded = cut(shared.filter("first").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("key"), "crowded-keys")
    if crowded.isEmpty():
        return shared
    of_text = shared.join(crowded, "key", "left_semi").groupBy("doc", "mark").agg(F.collect_set("place").alias("places"))
    windows = packed.join(of_text, ["doc", "mark"]).select("doc", "mark", "places", "packed").mapInArrow(_deal_windows(unit), _DEALT)
    return shared.join(crowded, "key", "left_anti").unionByName(_meet(windows))


def repeated_windows(df: DataFrame, packed: DataFrame, unit: Unit, index: Index, text: str, key: str, other_texts_only: bool, crowd: int | None = CROWD) -> DataFrame:
    """Return (doc, mark, parts): per text the covered ranges of symbols, as an array of (start, end).

    A window is covered if an equal one begins at a smaller (key, start), or
    with ``other_texts_only`` in a text with a smaller key. Texts without
    covered windows have no row. ``packed`` is :func:`packed_texts`; the caller
    joins the result to it, and Spark moves it once for both.
    """
    refs = _rows(df, text, key).select("doc", "mark", "text").mapInArrow(_deal(unit), _DEALT)
    shared = _meet(refs)
    if crowd is not None:
        shared = _split_crowds(shared, packed, unit, crowd)
    start, n = F.shiftright("place", _START), F.shiftright("place", _COUNT).bitwiseAND(F.lit(0xFF))
    symbols = shared.filter("first").agg(F.sum(n + unit.width)).first()[0] or 0
    shards = max(1, math.ceil(symbols * (8 if unit.words else 1) / SHARD_BYTES))
    places = shared.filter("first").groupBy("doc", "mark").agg(F.collect_list(F.struct("key", "hash", "place")).alias("places"))
    # The same left side, columns and join as in without_parts: one exchange of the texts serves both.
    parcels = packed.join(places, ["doc", "mark"], "left").select("doc", "places", "packed", "key").mapInArrow(_fetch(unit, shards), "shard long, parcel binary")
    found = parcels.groupBy("shard").applyInArrow(_runs(index), "key long, hash long, runs array<struct<at:int,n:int,doc:long,start:long>>")

    def earlier(run: Column) -> Column:
        if other_texts_only:
            return run["doc"] < F.col("doc")
        return (run["doc"] < F.col("doc")) | ((run["doc"] == F.col("doc")) & (run["start"] < F.col("from") + run["at"]))

    def part(run: Column) -> Column:
        begin = F.col("from") + run["at"]
        return F.struct(begin.alias("start"), (begin + run["n"] + F.lit(unit.width - 1)).alias("end"))

    met = shared.select("key", "hash", "doc", "mark", start.alias("from")).join(found, ["key", "hash"])
    covered = met.select("doc", "mark", F.transform(F.filter("runs", earlier), part).alias("parts")).filter("size(parts) > 0")
    return covered.groupBy("doc", "mark").agg(F.flatten(F.collect_list("parts")).alias("parts"))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges as maximal ranges in order."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.ones(len(starts), bool)
    fresh[1:] = starts[1:] > reach[:-1]
    last = np.append(np.flatnonzero(fresh)[1:], len(starts)) - 1
    return starts[fresh], reach[last]


def without_parts(packed: DataFrame, unit: Unit, parts: DataFrame, key: str) -> DataFrame:
    """Return per row of ``packed``: key, n_symbols, n_removed, spans (start, end) and kept (binary)."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                counts, removed, kept, spans = [], [], [], []
                for row in range(some.num_rows):
                    whole = unpack(some.column(1)[row].as_py())
                    symbols = whole.translate(_TO_SPACE).split() if unit.words else whole
                    found = some.column(2)[row]
                    left, cuts = symbols, []
                    if found.is_valid:
                        starts, ends = merged(*(c.to_numpy() for c in found.values.flatten()))
                        cuts = list(zip(starts.tolist(), ends.tolist(), strict=True))
                        edges = [0, *(x for pair in cuts for x in pair), len(symbols)]
                        pieces = [symbols[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
                        left = [w for p in pieces for w in p] if unit.words else b"".join(pieces)
                    counts.append(len(symbols))
                    removed.append(len(symbols) - len(left))
                    kept.append(b" ".join(left) if unit.words else left)
                    spans.append([{"start": a, "end": b} for a, b in cuts])
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                    ["key", "n_symbols", "n_removed", "spans", "kept"],
                )

    kind = packed.schema["key"].dataType.simpleString()
    joined = packed.join(parts, ["doc", "mark"], "left").select("key", "packed", "parts", "doc")
    kept = joined.mapInArrow(remove, f"key {kind}, n_symbols long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    return kept.withColumnRenamed("key", key)
