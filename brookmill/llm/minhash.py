"""MinHash near-dedup by improved consistent weighted sampling.

Shingles of five words weigh tf times a damped idf. Each text is sampled
``bands * rows`` times in proportion to its weights, so that two texts agree in
a sample with the probability of their weighted Jaccard similarity; texts that
agree in all samples of a band meet in a bucket. Equal texts count once, by
digest. Candidates are verified by the weighted Jaccard similarity of the whole
texts, and verified links are joined to classes.

Buckets are not expanded into all pairs. A bucket's leader is the member that
meets most others over all its buckets, so the centre of a group of copies, and
every text is compared with the most central of its leaders (a star). Afterwards only buckets that still
hold more than one class go on: small ones compare the classes' members across,
large ones take their next most central members as leaders of the rest, until
hardly any pair of a round is a link. These rounds only make classes grow cheaply: whatever members of
different classes a large bucket still holds are then all compared, block by
block. So a bucket costs a few rows per member while it is one class, and all
pairs across its classes otherwise.

Document frequencies are counted over all texts in a count-min sketch of fixed
size, the only thing that is broadcast (``2 * df_buckets * 4`` bytes).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmill.llm.rows import one_row_where
from brookmill.llm.tallies import tally
from brookmill.llm.windows import SLICE_BYTES, Sums, mix, pack, slices, texts_of, unpack, word_symbols, words_of
from brookmill.scratch import cut

#: Further leaders of a large bucket per round; when fewer than this share of the pairs compared are links, all others are compared.
HEADS, LEAST_GAIN = 2, 0.01
#: About so many members of a bucket meet as many others in one group.
BLOCK = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles(data: np.ndarray, edges: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of the distinct shingles, sorted by (text, hash).

    A-Z is lower-cased. A text of fewer than ``size`` words has one shingle of
    all of them, a text without words none.
    """
    data = _LOWER[data]
    starts, ends, word_edges = words_of(data, edges)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums = Sums(word_symbols(data, starts, ends))
    words = np.diff(word_edges)
    counts = np.where(words > 0, np.maximum(words - size + 1, 1), 0)
    text = np.repeat(np.arange(len(counts)), counts)
    begin = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + word_edges[:-1][text]
    end = np.minimum(begin + size, word_edges[1:][text])
    found = mix(sums.ranges(begin, end) + (end - begin).astype(np.uint64))
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
    first = np.flatnonzero(fresh)
    return text[first], found[first], np.diff(np.append(first, len(text)))


def _places(found: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of a shingle in the sketch."""
    return (found % np.uint64(buckets)).astype(np.int64), ((found >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64) + buckets


class Weights:
    """Weight of a shingle: count times 1 + ``damping`` * ln((1 + n) / (1 + df)) / ln(1 + n).

    ``df`` is at least the true document frequency; the sketch may add up to
    the number of shingles per cell.
    """

    def __init__(self, counts: np.ndarray, texts: int, damping: float) -> None:
        self.buckets = len(counts) // 2
        full = np.log(1.0 + max(texts, 1))
        self.cells = (1 + damping * np.log((1.0 + max(texts, 1)) / (1.0 + np.minimum(counts, texts))) / full).astype(np.float32)

    def of(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        one, two = _places(found, self.buckets)
        return np.maximum(self.cells[one], self.cells[two]) * counts.astype(np.float32)


def document_frequencies(rows: DataFrame, size: int, buckets: int) -> tuple[np.ndarray, int]:
    """Sketch counts and number of texts over all of ``rows`` (binary column ``text``)."""

    def fill(batch: pa.RecordBatch, cells: np.ndarray) -> None:
        for some in slices(batch, 0):
            _, found, _ = shingles(*texts_of(some.column(0)), size)
            for place in _places(found, buckets):
                np.add.at(cells, place, 1)

    return tally(rows.select("text"), fill, 2 * buckets)


def samples(text: np.ndarray, found: np.ndarray, weight: np.ndarray, count: int) -> np.ndarray:
    """Improved consistent weighted sampling: (texts with shingles, count) hashes of the chosen (shingle, level).

    For each sample, every shingle draws r and c from Gamma(2, 1) and b from
    [0, 1) by its hash; with t = floor(ln w / r + b) the shingle with the
    smallest c / exp(r (t - b + 1)) is chosen, together with t.
    """
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    sizes = np.diff(np.append(first, len(text)))
    log_weight = np.log(weight)
    out = np.empty((len(first), count), np.uint64)
    unit, half = np.float32(2.0**-16), np.float32(0.5)

    def uniform(h: np.ndarray, shift: int) -> np.ndarray:
        """16 bits of each hash as numbers within (0, 1)."""
        part = ((h >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.float32)
        part += half
        part *= unit
        return part

    for k in range(count):
        h = mix(found + np.uint64((k * 2 + 1) * 0x9E3779B97F4A7C15 % 2**64))
        r = uniform(h, 0)
        r *= uniform(h, 16)
        np.log(r, out=r)  # minus a Gamma(2, 1) number
        cost = uniform(h, 32)
        cost *= uniform(h, 48)
        np.log(cost, out=cost)
        np.negative(cost, out=cost)
        np.log(cost, out=cost)
        b = uniform(h * np.uint64(0xD1B54A32D192ED03) + np.uint64(k), 48)
        t = np.floor(b - log_weight / r)
        b -= t
        b -= np.float32(1)
        b *= r
        cost -= b
        least = np.minimum.reduceat(cost, first)
        at = np.flatnonzero(cost == np.repeat(least, sizes))
        owner = np.searchsorted(first, at, "right") - 1
        at = at[np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))]
        out[:, k] = mix(found[at] + t[at].astype(np.int64).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (sorted hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64)) - shared
    return shared / total if total else 0.0


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of the undirected ``links`` (a, b) but the smallest of each component, which is the label.

    Large and small stars in turn: every edge (high, low) moves its high end to
    the smallest neighbour of its low end, then every node moves its other low
    neighbours to the smallest. There is one row per link throughout, the
    smallest neighbour is a pre-aggregated minimum, and each round is written.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).filter("high <> low").distinct(), "near-edges")
    while True:
        least = edges.select(F.col("high").alias("low"), F.col("low").alias("near")).groupBy("low").agg(F.min("near").alias("near"))
        large = edges.join(least, "low", "left").select("high", F.coalesce("near", "low").alias("low"), F.col("near").isNotNull().alias("moved"))
        large = cut(large, "near-large-stars")
        best = large.groupBy("high").agg(F.min("low").alias("best"))
        other = F.col("low") != F.col("best")
        small = large.join(best, "high").select(F.when(other, F.col("low")).otherwise(F.col("high")).alias("high"), F.col("best").alias("low"), (F.col("moved") | other).alias("moved"))
        step = cut(small, "near-small-stars")
        edges = step.select("high", "low")
        if step.filter("moved").isEmpty():
            return edges.distinct().select(F.col("high").alias("node"), F.col("low").alias("label"))


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    threshold: float = 0.8,
    size: int = 5,
    bands: int = 16,
    rows: int = 3,
    damping: float = 0.2,
    df_buckets: int = 1 << 20,
    small: int = 8,
) -> DataFrame:
    """Return per row of ``df``: key, class_id (smallest key of its class), class_size, kept, text_md5.

    Two texts are linked if their weighted Jaccard similarity is at least
    ``threshold`` and they share a bucket (all but about (1 - s**rows)**bands of
    the pairs of similarity s); classes are what links join. Of each class the
    text with the smallest key is kept. ``damping`` is how much more than a
    shingle found everywhere one found nowhere else weighs: with full idf, the
    size of a group of copies would itself push its members apart. Null text
    counts as empty; texts without words are classed with equal texts only. A
    null key comes first and gives a null class_id. Rows that repeat key and
    text all count in class_size and are marked alike. Other columns are not read.
    """
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    docs = df.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("doc"), F.unhex(F.md5(content)).alias("digest"), content.alias("text"))
    cells, texts = document_frequencies(docs, size, df_buckets)
    weights = df.sparkSession.sparkContext.broadcast(Weights(cells, texts, damping))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 2, SLICE_BYTES // 4):
                owner, found, counts = shingles(*texts_of(some.column(2)), size)
                keys: list = [[] for _ in range(some.num_rows)]
                if len(owner):
                    drawn = samples(owner, found, weights.value.of(found, counts), bands * rows)
                    sums = np.stack([reduce(lambda a, b: mix(a + b), (drawn[:, i * rows + j] for j in range(rows)), np.full(len(drawn), i + 1, np.uint64)) for i in range(bands)], axis=1)
                    for at, row in zip(np.unique(owner).tolist(), sums.view(np.int64).tolist(), strict=True):
                        keys[at] = row
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(keys, pa.list_(pa.int64()))], ["doc", "digest", "bands"])

    signed = cut(docs.mapInArrow(sign, "doc long, digest binary, bands array<long>"), "near-signed")
    distinct = signed.groupBy("digest").agg(F.min("doc").alias("doc"), F.first("bands").alias("bands"))
    entries = distinct.select(F.explode("bands").alias("bucket"), "digest", "doc")
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    entries = cut(entries.join(shared, "bucket"), "near-entries")
    met = cut(entries.join(entries.groupBy("digest").agg(F.sum("n").alias("central")), "digest"), "near-buckets")
    leaders = met.groupBy("bucket").agg(F.max(F.struct("central", "digest")).alias("leader"))

    wanted = met.select("doc", "digest").distinct()
    packed = docs.mapInArrow(_pack_last, "doc long, digest binary, text binary")
    bodies = cut(packed.join(wanted, ["doc", "digest"], "left_semi").select("digest", "text"), "near-texts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)

        def vector(body: bytes) -> tuple[np.ndarray, np.ndarray]:
            data = np.frombuffer(unpack(body), np.uint8)
            _, found, counts = shingles(data, np.array([0, len(data)]), size)
            return found, weights.value.of(found, counts)

        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                if last[0] != name:
                    last = (name, vector(batch.column(3)[i].as_py()))
                keep.append(similarity(last[1], vector(batch.column(4)[i].as_py())) >= threshold)
            yield pa.RecordBatch.from_arrays(batch.columns[:3], ["a", "b", "label"]).filter(pa.array(keep, pa.bool_()))

    def verified(pairs: DataFrame) -> DataFrame:
        right = pairs.join(bodies.select(F.col("digest").alias("b"), F.col("text").alias("text_b")), "b")
        both = right.join(bodies.select(F.col("digest").alias("a"), F.col("text").alias("text_a")), "a")
        return cut(both.select("a", "b", "label", "text_a", "text_b").mapInArrow(verify, "a binary, b binary, label binary"), "near-links")

    first = met.join(leaders, "bucket").filter("digest <> leader.digest").groupBy(F.col("digest").alias("b")).agg(F.max("leader")["digest"].alias("a"))
    tried = [cut(first.select("a", "b", F.col("b").alias("label")), "near-pairs")]
    links = [verified(tried[0])]
    going = _open_buckets(met, _roots(links[0]))
    turn = 0
    while True:
        turn += 1
        more = cut(_next_pairs(going, links[1:], tried, turn, small), "near-pairs")
        count = more.count()
        if not count:
            break
        tried.append(more)
        links.append(verified(more))
        if links[-1].count() < LEAST_GAIN * count:
            break
    labels = cut(components(reduce(DataFrame.unionByName, links)), "near-labels")

    def compare(cell: pa.Table) -> pa.Table:
        """Links among the members of one cell; a pair of several shared buckets is compared in the smallest."""
        bucket = cell["bucket"][0].as_py()
        side, names, classes = (cell[c].to_pylist() for c in ("side", "digest", "label"))
        shared = [set(b) for b in cell["buckets"].to_pylist()]
        vectors = []
        for body in cell["text"]:
            data = np.frombuffer(unpack(body.as_py()), np.uint8)
            _, found, counts = shingles(data, np.array([0, len(data)]), size)
            vectors.append((found, weights.value.of(found, counts)))
        sums = [float(v[1].sum(dtype=np.float64)) for v in vectors]
        left = [i for i, s in enumerate(side) if s == 0]
        right = [i for i, s in enumerate(side) if s == 1]
        inner = cell["inner"][0].as_py()
        found = []
        for at, i in enumerate(left):
            for j in left[at + 1 :] if inner else right:
                if classes[i] == classes[j] or min(sums[i], sums[j]) < threshold * max(sums[i], sums[j]) * (1 - 1e-9):
                    continue
                if min(shared[i] & shared[j]) == bucket and similarity(vectors[i], vectors[j]) >= threshold:
                    found.append((names[i], names[j]))
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    rest = _rest(met, labels, small)
    if not rest.isEmpty():
        buckets = met.join(rest.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(F.collect_list("bucket").alias("buckets"))
        members = _cells(rest.join(buckets, "digest").join(bodies, "digest"))
        last = cut(members.groupBy("bucket", "inner", "i", "j").applyInArrow(compare, "a binary, b binary"), "near-links")
        if not last.isEmpty():
            labels = components(reduce(DataFrame.unionByName, [x.select("a", "b") for x in [*links, last]]))

    label = F.coalesce("label", "digest")
    named = signed.select("doc", "digest").join(labels.withColumnRenamed("node", "digest"), "digest", "left").select("doc", "digest", label.alias("label"))
    named = cut(named, "near-named")
    classes = named.groupBy("label").agg(F.min(F.struct("doc", "digest")).alias("first"), F.count(F.lit(1)).alias("class_size"))
    null = F.lit(None).cast("long")
    known = lambda c: F.when(F.col(c) == -(2**63), null).otherwise(F.col(c))
    return named.join(classes, "label").select(known("doc").alias(key), known("first.doc").alias("class_id"), "class_size", (F.struct("doc", "digest") == F.col("first")).alias("kept"), F.lower(F.hex("digest")).alias("text_md5"))


def keep_one_of_each(df: DataFrame, text: str = "text", key: str = "doc_id", **parameters) -> DataFrame:
    """One row with all columns of ``df`` for each class of :func:`near_duplicates`.

    Of rows that repeat key and text the one with the smallest row hash stays.
    Extra columns may have any names.
    """
    kept = near_duplicates(df, text, key, **parameters).filter("kept")
    return one_row_where(df, kept, key, F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")), F.col("text_md5"), F.col(text))


def _pack_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in slices(batch, 2, 8 * SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([pack(t.as_py()) for t in some.column(2)], pa.binary())], ["doc", "digest", "text"])


def _roots(links: DataFrame) -> DataFrame:
    """(digest, label) of the texts of the first links: the end of the chain of leaders.

    Every text has one leader at most, and a leader is more central than its
    members, so the links are chains without circles; they halve with each step.
    """
    pointers = cut(links.select(F.col("b").alias("digest"), F.col("a").alias("label")), "near-roots")
    while True:
        above = pointers.select(F.col("digest").alias("label"), F.col("label").alias("further"))
        step = cut(pointers.join(above, "label", "left").select("digest", F.coalesce("further", "label").alias("label"), F.col("further").isNotNull().alias("moved")), "near-roots")
        pointers = step.select("digest", "label")
        if step.filter("moved").isEmpty():
            return pointers


def _open_buckets(met: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries of the buckets that hold several classes after the first links, with label and size of the class."""
    sizes = roots.groupBy("label").agg((F.count(F.lit(1)) + 1).alias("size"))
    classed = met.join(roots, "digest", "left").withColumn("label", F.coalesce("label", "digest")).join(sizes, "label", "left")
    classed = classed.select("bucket", "digest", "n", "central", "label", F.coalesce("size", F.lit(1)).alias("size"))
    mixed = classed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("bucket")
    return cut(classed.join(mixed, "bucket"), "near-open")


def _next_pairs(going: DataFrame, links: list[DataFrame], tried: list[DataFrame], turn: int, small: int) -> DataFrame:
    """Fresh pairs (a, b, label of b) of different classes.

    In a large bucket the next ``HEADS`` most central members meet the members
    of classes no larger than their own that no link has joined to another class
    yet. That these heads are the first by row number lets Spark cut each task's
    rows down to them before the shuffle. In a small bucket, all members of
    different classes meet in the first turn.
    """
    large = going.filter(F.col("n") > small)
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("central"), "digest"))
    heads = large.withColumn("place", place).filter(F.col("place") <= HEADS * turn).filter(F.col("place") > HEADS * (turn - 1))
    heads = heads.select("bucket", F.col("digest").alias("a"), F.col("label").alias("label_a"), F.col("size").alias("size_a"))
    if links:
        large = large.join(reduce(DataFrame.unionByName, links).select("label").distinct(), "label", "left_anti")
    pairs = large.join(heads, "bucket").filter("label <> label_a AND size <= size_a").select("a", F.col("digest").alias("b"), "label")
    if turn == 1:
        few = going.filter(F.col("n") <= small)
        other = few.select("bucket", F.col("digest").alias("a"), F.col("label").alias("label_a"))
        across = few.join(other, "bucket").filter((F.col("a") < F.col("digest")) & (F.col("label") != F.col("label_a")))
        pairs = pairs.unionByName(across.select("a", F.col("digest").alias("b"), "label"))
    done = reduce(DataFrame.unionByName, tried)
    done = done.select("a", "b").unionByName(done.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.dropDuplicates(["a", "b"]).join(done, ["a", "b"], "left_anti")


def _rest(met: DataFrame, labels: DataFrame, small: int) -> DataFrame:
    """Entries of the large buckets that hold several classes, with label, the largest class, and the blocks of it and of the others."""
    classed = met.filter(F.col("n") > small).join(labels.withColumnRenamed("node", "digest"), "digest", "left")
    classed = classed.select("bucket", "digest", F.coalesce("label", "digest").alias("label"))
    counts = classed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = counts.groupBy("bucket").agg(F.sum("n").alias("total"), F.max(F.struct("n", "label")).alias("most")).filter("most.n < total")
    blocks = lambda n: F.ceil(n / BLOCK).cast("long")
    mixed = mixed.select("bucket", F.col("most.label").alias("major"), blocks(F.col("most.n")).alias("majors"), blocks(F.col("total") - F.col("most.n")).alias("minors"))
    return cut(classed.join(mixed, "bucket"), "near-rest")


def _cells(rest: DataFrame) -> DataFrame:
    """Entries dealt to cells (bucket, inner, i, j), so that any two of different classes meet in one.

    The largest class of a bucket meets the others in cells of (-1 - its block,
    their block); the others meet one another in cells of two of their blocks,
    and within one block in ``inner`` cells.
    """
    zero = F.lit(0).cast("long")
    of_major = F.col("label") == F.col("major")
    own = F.pmod(F.xxhash64("digest"), F.when(of_major, F.col("majors")).otherwise(F.col("minors")))

    def cell(inner: bool, i: Column, j: Column, side: Column) -> Column:
        return F.struct((F.lit(inner) & (i == j)).alias("inner"), F.when(F.lit(inner), i).otherwise(-1 - i).alias("i"), j.alias("j"), side.cast("int").alias("side"))

    minors, majors = F.sequence(zero, F.col("minors") - 1), F.sequence(zero, F.col("majors") - 1)
    to_minors = F.transform(minors, lambda j: cell(False, own, j, zero))
    to_majors = F.transform(majors, lambda i: cell(False, i, own, zero + 1))
    to_others = F.transform(minors, lambda j: cell(True, F.least(own, j), F.greatest(own, j), (own > j).cast("long")))
    dealt = rest.withColumn("cell", F.explode(F.when(of_major, to_minors).otherwise(F.concat(to_majors, to_others))))
    return dealt.select("bucket", "cell.*", "digest", "label", "buckets", "text")
