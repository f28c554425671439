"""Quality classifier: a byte-level convolutional network in numpy.

Filters over ``width`` bytes slide over every byte of a document. Their answers
are max-pooled within overlapping chunks that cover the whole text; a hidden
layer judges each chunk, and the mean over chunks gives one probability. All is
learned on the driver from a bounded sample of labelled rows, and scoring is one
pass of Arrow batches without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.llm.windows import slices, texts_of

BLOCK = 64
#: A chunk is so many blocks; the next begins one block before its end.
BLOCKS = 4
CHUNK = BLOCK * BLOCKS
HOP = BLOCKS - 1


@dataclass(frozen=True)
class Shape:
    embed: int = 8
    width: int = 6
    filters: int = 32
    hidden: int = 16


def padded_length(n: np.ndarray, width: int) -> np.ndarray:
    """Bytes of a text with zeros up to whole chunks; at least ``width`` - 1 zeros follow the text."""
    blocks = -(-(n + width - 1) // BLOCK)
    return (BLOCKS + HOP * np.maximum(0, -(-(blocks - BLOCKS) // HOP))) * BLOCK


class Network:
    """Weights and the two passes. Texts come as bytes padded with zeros."""

    def __init__(self, shape: Shape, seed: int) -> None:
        rng = np.random.default_rng(seed)
        s, self.shape = shape, shape
        normal = lambda *size, scale: (rng.standard_normal(size) * scale).astype(np.float32)
        self.w = {
            "embed": normal(256, s.embed, scale=0.5),
            "conv": normal(s.width * s.embed, s.filters, scale=1 / np.sqrt(s.width * s.embed / 4)),
            "conv_b": np.zeros(s.filters, np.float32),
            "dense": normal(s.filters, s.hidden, scale=np.sqrt(2 / s.filters)),
            "dense_b": np.zeros(s.hidden, np.float32),
            "out": normal(s.hidden, scale=np.sqrt(1 / s.hidden)),
            "out_b": np.zeros(1, np.float32),
        }

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter answers at each byte; what would reach behind ``data`` sees zeros."""
        s = self.shape
        seen = self.w["embed"][np.append(data, np.zeros(s.width - 1, np.uint8))]
        patches = np.lib.stride_tricks.sliding_window_view(seen.reshape(-1), s.width * s.embed)[:: s.embed]
        return np.ascontiguousarray(patches) @ self.w["conv"]

    def judge(self, pooled: np.ndarray) -> np.ndarray:
        """Hidden layer for each chunk from its pooled answers."""
        return np.maximum(np.maximum(pooled + self.w["conv_b"], 0) @ self.w["dense"] + self.w["dense_b"], 0)

    def score(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """One probability for each of the concatenated texts, over all their bytes."""
        s = self.shape
        sizes = np.diff(edges)
        padded = padded_length(sizes, s.width)
        begin = np.cumsum(padded) - padded
        buffer = np.zeros(padded.sum(), np.uint8)
        buffer[np.arange(len(data)) + np.repeat(begin - edges[:-1], sizes)] = data
        blocks = np.empty((len(buffer) // BLOCK, s.filters), np.float32)
        step = 1024 * BLOCK
        ends = begin + padded
        for at in range(0, len(buffer), step):
            part = buffer[at : at + step + s.width - 1]
            found = self.responses(part)[: min(step, len(buffer) - at)]
            over = ends[np.searchsorted(ends, at, "right") : np.searchsorted(ends, at + len(found), "right")] - at
            for back in range(1, s.width):
                found[over - back] = -np.inf  # reaches into the next text
            blocks[at // BLOCK : (at + len(found)) // BLOCK] = found.reshape(-1, BLOCK, s.filters).max(axis=1)
        chunks = (padded // BLOCK - BLOCKS) // HOP + 1
        first = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        first = np.repeat(begin // BLOCK, chunks) + first * HOP
        pooled = blocks[first]
        for i in range(1, BLOCKS):
            pooled = np.maximum(pooled, blocks[first + i])
        mean = np.add.reduceat(self.judge(pooled), np.cumsum(chunks) - chunks) / chunks[:, None]
        return 1 / (1 + np.exp(-(mean @ self.w["out"] + self.w["out_b"]).astype(np.float64)))

    def gradients(self, data: np.ndarray, owner: np.ndarray, docs: int, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss. ``data`` is (chunks, CHUNK + width - 1) bytes, ``owner`` the document of each chunk."""
        s, w = self.shape, self.w
        seen = w["embed"][data].reshape(len(data), -1)
        patches = np.lib.stride_tricks.sliding_window_view(seen, s.width * s.embed, axis=1)[:, :: s.embed]
        answers = (np.ascontiguousarray(patches).reshape(-1, s.width * s.embed) @ w["conv"]).reshape(len(data), CHUNK, s.filters)
        place = answers.argmax(axis=1)
        rows = np.arange(len(data))[:, None]
        pooled = answers[rows, place, np.arange(s.filters)] + w["conv_b"]
        lit = np.maximum(pooled, 0)
        before = lit @ w["dense"] + w["dense_b"]
        hidden = np.maximum(before, 0)
        counts = np.bincount(owner, minlength=docs).astype(np.float32)
        mean = np.zeros((docs, s.hidden), np.float32)
        np.add.at(mean, owner, hidden)
        mean /= counts[:, None]
        p = 1 / (1 + np.exp(-(mean @ w["out"] + w["out_b"])))
        d_logit = ((p - label) * weight / docs).astype(np.float32)
        d_hidden = (d_logit / counts)[owner, None] * w["out"] * (before > 0)
        d_pooled = (d_hidden @ w["dense"].T) * (pooled > 0)
        chosen = patches[rows, place]
        d_embed = np.zeros_like(w["embed"])
        d_patch = (d_pooled[:, :, None] * w["conv"].T[None]).reshape(len(data), s.filters, s.width, s.embed)
        np.add.at(d_embed, data[rows[:, :, None], place[:, :, None] + np.arange(s.width)], d_patch)
        return {
            "embed": d_embed,
            "conv": np.einsum("cfp,cf->pf", chosen, d_pooled),
            "conv_b": d_pooled.sum(0),
            "dense": lit.T @ d_hidden,
            "dense_b": d_hidden.sum(0),
            "out": mean.T @ d_logit,
            "out_b": d_logit.sum(keepdims=True),
        }


def fit(chunks: list[np.ndarray], labels: np.ndarray, shape: Shape, epochs: int, batch: int, rate: float, seed: int) -> Network:
    """Adam over shuffled batches; ``chunks`` holds (n, CHUNK + width - 1) bytes per document."""
    net, rng = Network(shape, seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    steps, total = 0, epochs * -(-len(chunks) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(chunks))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            owner = np.repeat(np.arange(len(some)), [len(chunks[i]) for i in some])
            grads = net.gradients(np.concatenate([chunks[i] for i in some]), owner, len(some), labels[some], np.ones(len(some), np.float32))
            steps += 1
            slow = rate * (1 - 0.9 * steps / total)
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                net.w[k] -= (slow * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.999**steps)) + 1e-7)).astype(np.float32)
    return net


class Constant:
    """Stands for a network where the labels leave nothing to learn."""

    def __init__(self, value: float) -> None:
        self.value = value

    def score(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return np.full(len(edges) - 1, self.value)


def in_fold(key: Column) -> Column:
    """Rows whose crc32 of the key as text leaves 2 when divided by 4; a null key is outside."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(df: DataFrame, labels: DataFrame, text: str, key: str, label: str, most_rows: int, most_chunks: int, shape: Shape, epochs: int, batch: int, rate: float, seed: int) -> Network | Constant:
    """Fit on the labelled rows outside the held-out fold.

    At most ``most_rows`` of them (those with the smallest key hash) and of each
    at most ``most_chunks`` chunks, evenly spaced over the whole text, are
    gathered: a few MB at any size of ``df``. Of several rows with one key the
    one with the smallest text hash is taken. Labels of one key are averaged,
    null keys and labels do not count. With labels of one kind only the score
    is that label, with none it is 1.
    """
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("double").alias("y")).dropna().filter(~in_fold(F.col("id")))
    known = known.groupBy("id").agg(F.round(F.avg("y")).alias("y")).orderBy(F.xxhash64("id"), "id").limit(most_rows)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for whole in rows.column(2):
                data = np.frombuffer(whole.as_py(), np.uint8)
                size = int(padded_length(np.array([len(data)]), shape.width)[0])
                padded = np.zeros(size + shape.width - 1, np.uint8)
                padded[: len(data)] = data
                count = (size // BLOCK - BLOCKS) // HOP + 1
                chosen = np.unique(np.linspace(0, count - 1, min(count, most_chunks)).round().astype(int)) * HOP * BLOCK
                out.append(b"".join(padded[c : c + CHUNK + shape.width - 1].tobytes() for c in chosen))
            yield pa.RecordBatch.from_arrays([*rows.columns[:2], rows.column(3), pa.array(out, pa.binary())], ["id", "y", "draw", "chunks"])

    texts = df.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    drawn = texts.join(F.broadcast(known), "id").select("id", "y", "text", F.xxhash64("text").alias("draw"))
    chosen = drawn.mapInArrow(gather, f"id {kind}, y double, draw long, chunks binary").groupBy("id", "y")
    found = chosen.agg(F.min_by("chunks", F.struct("draw", "chunks")).alias("chunks")).collect()
    found.sort(key=lambda r: (r["id"], r["chunks"]))
    y = np.array([r["y"] for r in found], np.float32)
    if not len(y) or y.min() == y.max():
        return Constant(float(y[0]) if len(y) else 1.0)
    chunks = [np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK + shape.width - 1) for r in found]
    return fit(chunks, y, shape, epochs, batch, rate, seed)


def quality_scores(
    df: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    threshold: float = 0.7,
    most_rows: int = 3000,
    most_chunks: int = 8,
    shape: Shape = Shape(),
    epochs: int = 12,
    batch: int = 32,
    rate: float = 0.004,
    seed: int = 11,
    keep_columns: bool = False,
) -> DataFrame:
    """Return per row of ``df``: key, held_out, score (0 to 1), predicted (1 if score >= ``threshold``).

    Only the text goes into a score. Null text counts as empty, and empty texts
    get the score of a chunk of padding; a null key is not held out. Repeated
    rows get equal scores, and an empty table an empty result. With
    ``keep_columns`` the columns of ``df`` come back instead, for the rows with
    predicted 1.
    """
    net = train(df, labels, text, key, label, most_rows, most_chunks, shape, epochs, batch, rate, seed)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for some in slices(rows, rows.num_columns - 1):
                scores = net.score(*texts_of(some.column(some.num_columns - 1)))
                if keep_columns:
                    yield pa.RecordBatch.from_arrays(some.columns[:-1], names).filter(pa.array(scores >= threshold))
                else:
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array(scores)], ["key", "score"])

    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    if keep_columns:
        names = [f"c{i}" for i in range(len(df.columns))]
        passed = df.toDF(*names)
        content = F.coalesce(F.col(names[df.columns.index(text)]), F.lit("")).cast("binary")
        return passed.select(*names, content.alias("content")).mapInArrow(score, passed.schema).toDF(*df.columns)
    rows = df.select(F.col(key).alias("key"), content.alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"key {kind}, score double")
    return scored.select(F.col("key").alias(key), in_fold(F.col("key")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
