"""A quality classifier: a factorisation machine over words, structure and size.

Inputs of a text are its words, hashed; statistics of its structure; and its size.
Each input has a weight and a vector of a few factors, and two inputs interact by
the inner product of their vectors. The sum over all pairs is half of the squared
sum less the sum of squares, so a text is scored in time linear in its words.

It is learnt on the driver from at most ``SAMPLE`` labelled texts, of which the
driver gets hashed inputs, never texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.textbytes import PIECE, row_groups, string_bytes, word_hashes

WORDS = 1 << 13  # hashed words
FACTORS = 6
SAMPLE = 4000  # labelled texts, the bound of what is learnt from
EPOCHS = 12
BATCH = 100
RATE = 0.05
SHRINK = 1e-5
GOOD = 0.7  # a score from here on is predicted as 1

# Classes of bytes whose shares tell how a text is built.
_CLASS = np.zeros(256, np.int64)  # 0: control
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[0x20] = 4
_CLASS[0x0A] = 5
_CLASS[list(b".,;:'\"-()")] = 6
_CLASS[list(b"!?")] = 7
_CLASS[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = 8
_CLASS[0x80:] = 9
_CLASSES = 10
_STATISTICS = _CLASSES + 7
INPUTS = WORDS + _STATISTICS


def _shares(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The share of each class of bytes in each row."""
    n = len(offsets) - 1
    counts = np.zeros((n, _CLASSES))
    for at in range(int(offsets[0]), int(offsets[-1]), 4 * PIECE):
        part = data[at : min(at + 4 * PIECE, int(offsets[-1]))]
        rows = np.searchsorted(offsets, np.arange(at, at + len(part)), "right") - 1
        counts += np.bincount(rows * _CLASSES + _CLASS[part], minlength=n * _CLASSES).reshape(n, -1)
    return counts / np.maximum(np.diff(offsets), 1)[:, None]


def inputs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, input, value) of every input that is not 0, by row.

    Words are damped counts of length 1 together. Statistics are the byte classes'
    shares, the size, word lengths, and how much words, neighbours and the most
    frequent word repeat.
    """
    data, offsets = string_bytes(column)
    n = len(offsets) - 1
    hashes, bounds = word_hashes(column)
    many = np.diff(bounds)
    rows = np.repeat(np.arange(n), many)
    key, counts = np.unique(rows * WORDS + (hashes % np.uint64(WORDS)).astype(np.int64), return_counts=True)
    word_row = key // WORDS
    damped = np.log1p(counts)
    norm = np.sqrt(np.bincount(word_row, damped**2, n))
    distinct = np.bincount(word_row, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, word_row, counts)
    again = np.zeros(n)
    if len(hashes) > 1:
        same = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
        again = np.bincount(rows[1:][same], minlength=n)
    total = np.maximum(many, 1)
    size = np.diff(offsets)
    statistics = np.column_stack(
        [
            _shares(data, offsets) * 3,
            np.log1p(size) / 10,
            np.log1p(many) / 10,
            np.minimum(size / total / 10, 3),
            distinct / total,
            most / total,
            again / total,
            many == 0,
        ]
    )
    row = np.concatenate([word_row, np.repeat(np.arange(n), _STATISTICS)])
    which = np.concatenate([key % WORDS, np.tile(np.arange(WORDS, INPUTS), n)])
    value = np.concatenate([damped / np.maximum(norm[word_row], 1e-9), statistics.ravel()])
    order = np.argsort(row, kind="stable")
    return row[order], which[order], value[order]


@dataclass
class FactorisationMachine:
    """bias, a weight for each input, and a vector of factors for each input."""

    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def raw(self, row, which, value, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and each row's summed factors."""
        scaled = self.factors[which] * value[:, None]
        sums = np.column_stack([np.bincount(row, scaled[:, f], n) for f in range(scaled.shape[1])])
        squares = np.bincount(row, (scaled**2).sum(axis=1), n)
        linear = np.bincount(row, self.weight[which] * value, n)
        return self.bias + linear + ((sums**2).sum(axis=1) - squares) / 2, sums

    def score(self, column: pa.Array) -> np.ndarray:
        row, which, value = inputs(column)
        return 1 / (1 + np.exp(-np.clip(self.raw(row, which, value, len(column))[0], -30, 30)))


def _descend(examples: list[tuple[int, np.ndarray, np.ndarray]]) -> FactorisationMachine:
    """Logistic loss by AdaGrad over shuffled batches; the seed is fixed."""
    rng = np.random.default_rng(3)
    good = float(np.mean([label for label, _, _ in examples]))
    good = min(max(good, 0.01), 0.99)
    model = FactorisationMachine(
        float(np.log(good / (1 - good))), np.zeros(INPUTS), rng.normal(0, 0.05, (INPUTS, FACTORS))
    )
    seen = np.full(INPUTS, 1e-3), np.full((INPUTS, FACTORS), 1e-3)
    for _ in range(EPOCHS):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            batch = [examples[i] for i in order[at : at + BATCH]]
            n = len(batch)
            labels = np.array([label for label, _, _ in batch], float)
            row = np.repeat(np.arange(n), [len(which) for _, which, _ in batch])
            which = np.concatenate([which for _, which, _ in batch])
            value = np.concatenate([value for _, _, value in batch])
            raw, sums = model.raw(row, which, value, n)
            slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels) / n
            own, place = np.unique(which, return_inverse=True)
            pull = slope[row] * value
            step = np.bincount(place, pull) + SHRINK * model.weight[own]
            seen[0][own] += step**2
            model.weight[own] -= RATE * step / np.sqrt(seen[0][own])
            across = pull[:, None] * (sums[row] - model.factors[which] * value[:, None])
            turn = np.column_stack([np.bincount(place, across[:, f]) for f in range(FACTORS)])
            turn += SHRINK * model.factors[own]
            seen[1][own] += turn**2
            model.factors[own] -= RATE * turn / np.sqrt(seen[1][own])
            model.bias -= RATE * slope.sum()
    return model


def _packed_inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in row_groups(batch, "text"):
            row, which, value = inputs(part.column("text"))
            bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("label"),
                    pa.array([which[a:b].astype(np.int32).tobytes() for a, b in zip(bounds, bounds[1:])]),
                    pa.array([value[a:b].astype(np.float32).tobytes() for a, b in zip(bounds, bounds[1:])]),
                ],
                names=["doc_id", "label", "which", "value"],
            )


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorisationMachine:
    """Learns from ``docs`` (doc_id, text) and ``labels`` (doc_id, label: 0 or 1).

    Of the labels, the ``sample`` whose hashed ids are smallest are used. Rows with a
    null id, label or text are not; of several texts or labels of one id one is.
    Without any, every score is one half.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col("label").cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = (
        docs.select("doc_id", "text")
        .where(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows of two numbers
        .select("doc_id", "label", "text")
        .mapInArrow(_packed_inputs, f"doc_id {kind}, label int, which binary, value binary")
        .groupBy("doc_id")
        .agg(F.min(F.struct("label", "which", "value")).alias("example"))
        .select("doc_id", "example.*")
    )
    rows = sorted(packed.collect(), key=lambda r: r["doc_id"])
    if not rows:
        return FactorisationMachine(0.0, np.zeros(INPUTS), np.zeros((INPUTS, FACTORS)))
    return _descend(
        [
            (r["label"], np.frombuffer(r["which"], np.int32), np.frombuffer(r["value"], np.float32))
            for r in rows
        ]
    )


def with_quality(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """``docs`` with ``quality_score`` from 0 to 1; a null text is scored as an empty one.

    All rows and other columns stay; a column of that name is replaced.
    """
    docs = docs.drop("quality_score")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_groups(batch, "text"):
                score = model.score(part.column("text"))
                yield part.append_column("quality_score", pa.array(score))

    return docs.mapInArrow(run, ", ".join([*fields, "quality_score double"]))
