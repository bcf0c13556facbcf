"""Quality classifier: a convolutional network over bytes, in numpy.

Each byte is twelve fixed numbers (seven character classes and its five low bits). Learned filters of ``WIDTH`` bytes run
over the whole text at steps of ``STRIDE``; their rectified outputs are max-pooled over chunks of ``2 * BLOCK`` places,
each chunk overlapping the next by half, and the chunks' values are combined by their mean and their maximum into one
logistic probability. Filters and combination are trained together by Adam on the cross-entropy.

Training takes at most ``Training.rows_a_class`` labelled documents of each class, the first in hash order, and
at most ``Training.bytes_a_class`` bytes of them: a bounded, documented sample. A text that does not fit into what is left
of the bytes is passed over, and one over the whole bound never reaches the driver. Scoring reads every text whole, in stretches of
bounded size whose chunks are those of the whole text.

A null text counts as empty; an empty text is one chunk of padding. If labelled rows of a class are missing, the model
gives the share of label 1 (0.5 without labels). Repeated doc_ids are scored row by row; of repeated labels the
greatest counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_arrow

WIDTH, STRIDE, FILTERS, BLOCK = 7, 3, 24, 96
BLOCKS_AT_ONCE = 512


@dataclass(frozen=True)
class Training:
    rows_a_class: int = 1500
    bytes_a_class: int = 6_000_000
    epochs: int = 6
    batch: int = 32
    rate: float = 0.01
    seed: int = 5


def _byte_numbers() -> np.ndarray:
    b = np.arange(256)
    classes = [
        (b >= 97) & (b <= 122),
        (b >= 65) & (b <= 90),
        (b >= 48) & (b <= 57),
        (b == 32) | (b == 9),
        (b == 10) | (b == 13),
        b >= 128,
        (b > 32) & (b < 127) & ~((b >= 97) & (b <= 122)) & ~((b >= 65) & (b <= 90)) & ~((b >= 48) & (b <= 57)),
    ]
    bits = [((b >> k) & 1) - 0.5 for k in range(5)]
    numbers = np.stack([*(c.astype(float) for c in classes), *bits], axis=1).astype(np.float32)
    numbers[0] = 0
    return numbers


NUMBERS = _byte_numbers()
INPUTS = WIDTH * NUMBERS.shape[1]


def blocks_of(data: bytes) -> Iterator[np.ndarray]:
    """Byte windows (blocks, BLOCK, WIDTH) of the whole text, zero-padded at its end, some blocks at a time."""
    span = BLOCK * STRIDE
    total = max(1, -(-max(0, len(data) - WIDTH + STRIDE) // span))
    for at in range(0, total, BLOCKS_AT_ONCE):
        n = min(BLOCKS_AT_ONCE, total - at)
        size = n * span + WIDTH - STRIDE
        piece = np.zeros(max(size, n * span + WIDTH), np.uint8)
        part = np.frombuffer(data, np.uint8)[at * span : at * span + size]
        piece[: len(part)] = part
        windows = np.lib.stride_tricks.sliding_window_view(piece, WIDTH)[::STRIDE][: n * BLOCK]
        yield windows.reshape(n, BLOCK, WIDTH)


@dataclass
class Network:
    filters: np.ndarray  # INPUTS x FILTERS
    offsets: np.ndarray  # FILTERS
    weights: np.ndarray  # 2 * FILTERS: of the chunks' mean and maximum
    bias: float
    constant: float | None = None

    def outputs(self, windows: np.ndarray) -> np.ndarray:
        n = windows.shape[0]
        x = NUMBERS[windows.reshape(-1, WIDTH)].reshape(-1, INPUTS)
        return np.maximum(x @ self.filters + self.offsets, 0).reshape(n, BLOCK, FILTERS)

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        data = (text or "").encode("utf-8", "surrogatepass")
        pooled = np.concatenate([self.outputs(w).max(axis=1) for w in blocks_of(data)])
        chunks = np.maximum(pooled[:-1], pooled[1:]) if len(pooled) > 1 else pooled
        z = float(np.concatenate((chunks.mean(axis=0), chunks.max(axis=0))) @ self.weights + self.bias)
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _gradient(net: Network, data: bytes, label: float) -> list[np.ndarray]:
    windows = np.concatenate(list(blocks_of(data)))
    out = net.outputs(windows)
    top = out.argmax(axis=1)  # blocks x FILTERS
    pooled = np.take_along_axis(out, top[:, None, :], axis=1)[:, 0, :]
    n = len(pooled)
    if n > 1:
        later = pooled[1:] > pooled[:-1]
        block = np.arange(n - 1)[:, None] + later
    else:
        block = np.zeros((1, FILTERS), int)
    each = np.arange(FILTERS)
    chunks = pooled[block, each]
    best = chunks.argmax(axis=0)
    features = np.concatenate((chunks.mean(axis=0), chunks[best, each]))
    z = float(features @ net.weights + net.bias)
    error = 1 / (1 + math.exp(-max(-60.0, min(60.0, z)))) - label
    back = np.broadcast_to(net.weights[:FILTERS] / len(chunks), chunks.shape).copy()
    back[best, each] += net.weights[FILTERS:]
    back = (back * (chunks > 0) * error).astype(np.float32)
    x = NUMBERS[windows[block, top[block, each]]].reshape(len(chunks), FILTERS, INPUTS)
    return [np.einsum("cf,cfi->if", back, x), back.sum(axis=0), features * error, np.array([error])]


def train(examples: list[tuple[bytes, int]], conf: Training = Training()) -> Network:
    """Fit on (text in UTF-8, label) pairs."""
    ones = sum(label for _, label in examples)
    rng = np.random.default_rng(conf.seed)
    start = [
        rng.normal(0, 1 / math.sqrt(INPUTS / 3), (INPUTS, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        np.zeros(1, np.float32),
    ]
    if ones in (0, len(examples)):
        return Network(*start[:3], 0.0, constant=ones / len(examples) if examples else 0.5)
    values, first, second, step = start, [0.0] * 4, [0.0] * 4, 0
    for epoch in range(conf.epochs):
        order = rng.permutation(len(examples))
        rate = conf.rate * (1 - epoch / conf.epochs)
        for i in range(0, len(order), conf.batch):
            net = Network(*values[:3], float(values[3][0]))
            grads = [_gradient(net, *examples[k]) for k in order[i : i + conf.batch]]
            step += 1
            for k in range(4):
                g = sum(g[k] for g in grads) / len(grads) + 1e-4 * values[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                values[k] = (values[k] - rate * move).astype(np.float32)
    return Network(*values[:3], float(values[3][0]))


def learn(docs: DataFrame, labels: DataFrame, conf: Training = Training()) -> Network:
    """Fit on the bounded sample of ``docs`` (doc_id, text) that ``labels`` (doc_id, quality) marks."""
    marked = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("y"))
    text = column("text").cast("string")
    rows = docs.select(column("doc_id").alias("doc_id"), text.alias("text"))
    rows = rows.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= conf.bytes_a_class)
    # labels of rows that are not there use up no place of the sample
    marked = marked.join(rows.select("doc_id").distinct(), "doc_id")
    examples: list[tuple[bytes, int]] = []
    for y in (0, 1):
        chosen = marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(conf.rows_a_class)
        # at most rows_a_class pairs of integers; of a repeated doc_id the text of least hash counts
        sample = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
        sample = sample.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id")
        total = 0
        for r in sample.toLocalIterator():
            data = (r["text"] or "").encode("utf-8", "surrogatepass")
            if total + len(data) <= conf.bytes_a_class:
                total += len(data)
                examples.append((data, y))
    return train(examples, conf)


def scored(docs: DataFrame, net: Network, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, score and predicted of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [net.score(t) for t in batch.column(len(keep)).to_pylist()]
            arrays = [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), *arrays], [*keep, "score", "predicted"]
            )

    rows = docs.select(*[column(c) for c in keep], column("text").cast("string").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_arrow(rows, run, f"{kinds}, score double, predicted int")
