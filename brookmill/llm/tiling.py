"""Benchmark decontamination by greedy string tiling.

Words are compared in lower case without punctuation. Seeds are the ``seed``-word
substrings of the benchmark. A fixed-size bitmap of their hashes goes to every
task (at most ``bits`` / 8 bytes, however large the benchmark); documents give
the hashes that may be seeds, and a join with the seed table finds pairs of a
document and an item. Pairs with enough seeds for the asked coverage are tiled:
running Karp-Rabin hashes find the longest common runs of words, which are
marked without overlap from the longest down to ``shortest`` words. The share of
the item's words under tiles is the coverage. As tiles may come in any order, a
passage with its sentences reordered is covered like the original.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmill.llm.rows import rows_where
from brookmill.llm.tallies import tally
from brookmill.llm.windows import Sums, mix, pack, slices, texts_of, unpack, word_symbols, words_of
from brookmill.scratch import cut

#: Letters A-Z in lower case; ASCII other than letters and digits separates words.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)


def words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of concatenated texts, and the edges of the texts in words."""
    data = _FOLD[data]
    starts, ends, word_edges = words_of(data, edges)
    return word_symbols(data, starts, ends), word_edges


def grams(found: np.ndarray, edges: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word substrings within each text, and the text of each."""
    counts = np.maximum(np.diff(edges) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    begin = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + edges[:-1][text]
    return mix(Sums(found).ranges(begin, begin + size) + np.uint64(size)), text


def tiles(item: np.ndarray, text: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word arrays: (place in item, place in text, length) of each tile.

    The search length starts at the whole item and halves; all maximal common
    runs of at least that length over unmarked words are marked from the longest
    on. A run that earlier marks cut short is tried again with what is left.
    """
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    sums_item, sums_text = Sums(item), Sums(text)
    found: list[tuple[int, int, int]] = []
    length = max(shortest, len(item))
    while len(item) >= shortest and len(text) >= shortest:
        while True:
            runs = _common_runs(item, text, free_item, free_text, sums_item, sums_text, length)
            if not runs:
                break
            marked = False
            for size, i, j in sorted(runs, key=lambda r: (-r[0], r[1], r[2])):
                if free_item[i : i + size].all() and free_text[j : j + size].all():
                    free_item[i : i + size] = free_text[j : j + size] = False
                    found.append((i, j, size))
                    marked = True
            if not marked:
                break
        if length == shortest:
            break
        length = max(shortest, length // 2)
    return found


def _common_runs(item: np.ndarray, text: np.ndarray, free_item: np.ndarray, free_text: np.ndarray, sums_item: Sums, sums_text: Sums, length: int) -> set[tuple[int, int, int]]:
    """Maximal runs (length, place in item, place in text) of unmarked equal words, at least ``length`` long."""
    if length > len(item) or length > len(text):
        return set()
    at = np.flatnonzero(np.convolve(free_item, np.ones(length, int), "valid") == length)
    of_item = sums_item.ranges(at, at + length)
    to = np.flatnonzero(np.convolve(free_text, np.ones(length, int), "valid") == length)
    of_text = sums_text.ranges(to, to + length)
    hits = np.flatnonzero(np.isin(of_text, of_item))
    places = defaultdict(list)
    for i, h in zip(at.tolist(), of_item.tolist(), strict=True):
        places[h].append(i)
    runs: set[tuple[int, int, int]] = set()
    reached: dict[int, int] = {}
    for j, h in zip(to[hits].tolist(), of_text[hits].tolist(), strict=True):
        for i in places[h]:
            if reached.get(j - i, -1) >= j + length:
                continue  # inside a run of this diagonal
            size = length
            while i + size < len(item) and j + size < len(text) and free_item[i + size] and free_text[j + size] and item[i + size] == text[j + size]:
                size += 1
            reached[j - i] = j + size
            if (item[i : i + length] == text[j : j + length]).all():
                runs.add((size, i, j))
    return runs


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    coverage: float = 0.5,
    seed: int = 5,
    shortest: int = 5,
    bits: int = 1 << 24,
) -> DataFrame:
    """Return per row of ``df``: key, contaminated, items (covered benchmark items), best_coverage.

    ``items`` lists the items of which at least ``coverage`` of the words lie
    under tiles of at least ``shortest`` words (an item of fewer words: under
    itself as a whole), in order; ``best_coverage`` is the largest share among
    them, 0 without any. Null texts count as empty; items without words are
    never found; repeated items count once, items with a null id are found and
    listed as null last. A null key is passed on; rows that repeat key and text
    get equal rows. Other columns are not read.
    """
    if shortest < seed:
        raise ValueError("shortest is at least seed")
    content = lambda c: F.coalesce(F.col(c), F.lit("")).cast("binary")
    items = cut(
        benchmark.select(F.col(item).alias("item"), F.xxhash64(item_text, item).alias("number"), content(item_text).alias("body")).dropDuplicates(["number"]),
        "tiling-items",
    )

    def sow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1):
                found, edges = words(*texts_of(some.column(1)))
                for row in range(some.num_rows):
                    own = found[edges[row] : edges[row + 1]]
                    size = min(seed, len(own))
                    if not size:
                        continue
                    hashes, count = np.unique(grams(own, np.array([0, len(own)]), size)[0], return_counts=True)
                    full = lambda v, t: pa.array(np.full(len(hashes), v), t)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes.view(np.int64)), pa.array(count), full(some.column(0)[row].as_py(), pa.int64()), full(len(own), pa.int64()), full(size, pa.int32())],
                        ["seed", "places", "number", "n_words", "size"],
                    )

    seeds = cut(items.select("number", "body").mapInArrow(sow, "seed long, places long, number long, n_words long, size int"), "tiling-seeds")
    sizes = [r["size"] for r in seeds.select("size").distinct().collect()]  # at most ``seed`` numbers

    def plant(batch: pa.RecordBatch, cells: np.ndarray) -> None:
        cells[(batch.column(0).to_numpy().view(np.uint64) % np.uint64(bits)).astype(np.int64)] = True

    cells, _ = tally(seeds.select("seed"), plant, bits, np.bool_)
    bitmap = df.sparkSession.sparkContext.broadcast(np.packbits(cells))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sown = bitmap.value
        for batch in batches:
            for some in slices(batch, 3):
                found, edges = words(*texts_of(some.column(3)))
                hashes, owner = [], []
                for size in sizes:
                    gram, text_of = grams(found, edges, size)
                    at = gram % np.uint64(bits)
                    hit = np.flatnonzero((sown[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1)
                    hashes.append(gram[hit])
                    owner.append(text_of[hit])
                hits: list[list[int]] = [[] for _ in range(some.num_rows)]
                bodies: list[bytes | None] = [None] * some.num_rows
                hashes, owner = np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([np.zeros(0, np.int64), *owner])
                for row in np.unique(owner).tolist():
                    hits[row] = np.unique(hashes[owner == row]).view(np.int64).tolist()
                    bodies[row] = pack(some.column(3)[row].as_py())
                yield pa.RecordBatch.from_arrays([*some.columns[:3], pa.array(hits, pa.list_(pa.int64())), pa.array(bodies, pa.binary())], ["key", "doc", "mark", "hits", "body"])

    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("doc"), F.xxhash64(text).alias("mark"), content(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    seen = cut(rows.mapInArrow(look, f"key {kind}, doc long, mark long, hits array<long>, body binary"), "tiling-hits")

    met = seen.select("doc", "mark", F.explode("hits").alias("seed")).join(seeds, "seed").groupBy("doc", "mark", "number")
    # A tile of ``shortest`` words or more holds at least this share of its words as seeds.
    enough = F.col("shared") >= coverage * F.col("n_words") * (shortest - seed + 1) / shortest
    pairs = met.agg(F.sum("places").alias("shared"), F.first("n_words").alias("n_words")).filter(enough).select("doc", "mark", "number")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares = []
            for own, body in zip(batch.column(3), batch.column(4), strict=True):
                both = [np.frombuffer(b, np.uint8) for b in (own.as_py(), unpack(body.as_py()))]
                one, two = (words(b, np.array([0, len(b)]))[0] for b in both)
                shares.append(sum(t[2] for t in tiles(one, two, min(shortest, len(one)))) / len(one))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(shares, pa.float64())], ["doc", "mark", "item", "share"])

    bodies = seen.filter("body IS NOT NULL").select("doc", "mark", F.col("body").alias("packed")).dropDuplicates(["doc", "mark"])
    joined = pairs.join(items, "number").join(bodies, ["doc", "mark"]).select("doc", "mark", "item", "body", "packed")
    covered = joined.mapInArrow(tile, f"doc long, mark long, item {items.schema['item'].dataType.simpleString()}, share double")
    order = F.sort_array(F.collect_list(F.struct(F.col("item").isNull().alias("last"), "item")))
    best = covered.filter(F.col("share") >= coverage).groupBy("doc", "mark").agg(order.alias("found"), F.max("share").alias("share"))
    empty = F.array().cast(f"array<{items.schema['item'].dataType.simpleString()}>")
    return seen.select("key", "doc", "mark").join(best, ["doc", "mark"], "left").select(
        F.col("key").alias(key),
        F.col("share").isNotNull().alias("contaminated"),
        F.coalesce(F.col("found.item"), empty).alias("items"),
        F.coalesce("share", F.lit(0.0)).alias("best_coverage"),
        F.col("mark").alias("text_mark"),
    )


def without_contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", **parameters) -> DataFrame:
    """The rows of ``df`` that :func:`contaminated` does not mark, with all columns, which may have any names."""
    marked = contaminated(df, benchmark, text, key, **parameters).filter("contaminated")
    return rows_where(df, marked, key, F.xxhash64(text), F.col("text_mark"), "left_anti")
