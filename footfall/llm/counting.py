"""Corpus-wide counts of hashes, asked for by chunks of rows.

Rows are dealt over chunks. A chunk sends its distinct hashes with their own counts,
sorted and cut into hash ranges called buckets. A bucket adds up all chunks' counts
and sends each chunk the totals of just the hashes it asked for, in its own order.
So a frequent hash crosses the network once a chunk, and no task holds all hashes.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ASKED = "bucket int, chunk long, n int, keys binary, counts binary"
ANSWERED = "chunk long, n int, bucket int, counts binary"


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the summed weights of each (by default how often it occurs)."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, weights, len(distinct)).astype(np.int64)


def _small(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest needs; the first byte says how many."""
    width = next(w for w in (1, 2, 4, 8) if counts.max(initial=0) < 1 << (8 * w - 1))
    return bytes([width]) + counts.astype(f"<i{width}").tobytes()


def _large(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<i{raw[0]}", offset=1).astype(np.int64)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, each in as few bytes as the largest needs."""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    raw = steps.astype("<u8").view(np.uint8).reshape(-1, 8)
    return bytes([width]) + raw[:, :width].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    parts = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, raw[0])
    steps = np.zeros((len(parts), 8), np.uint8)
    steps[:, : raw[0]] = parts
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def ask(
    chunk: int, buckets: int, parts: Iterable[tuple[int, np.ndarray, np.ndarray]]
) -> pa.Table:
    """A chunk's rows for (n, sorted distinct uint64 keys, counts); n keeps kinds of keys apart."""
    width = ((1 << 64) - 1) // buckets + 1
    edges = np.array([b * width for b in range(1, buckets)], np.uint64)
    rows: list[tuple[int, int, int, bytes, bytes]] = []
    for n, keys, counts in parts:
        cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
        for bucket in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[bucket], cuts[bucket + 1])
            # Less its range's begin, a key takes fewer bytes.
            near = keys[own] - np.uint64(bucket * width)
            rows.append((bucket, chunk, n, _packed(near), _small(counts[own])))
    columns = list(zip(*rows)) or [()] * 5
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    names = ("bucket", "chunk", "n", "keys", "counts")
    return pa.table({name: pa.array(c, kind) for name, c, kind in zip(names, columns, kinds)})


def _merged(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """The summed counts of a bucket's distinct keys, and where each row's keys are in them."""
    keys = [_unpacked(k.as_py()) for k in table.column("keys")]
    kind = np.repeat(np.asarray(table.column("n")), [len(k) for k in keys]).astype(np.uint64)
    # Kinds are few, and keys are hashes already: a shifted copy keeps them apart.
    apart = np.concatenate(keys) ^ (kind * np.uint64(0xD6E8FEB86659FD93))
    counts = np.concatenate([_large(c.as_py()) for c in table.column("counts")])
    distinct, place = np.unique(apart, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, counts)
    return total, np.split(place, np.cumsum([len(k) for k in keys])[:-1])


def _back(table: pa.Table) -> pa.Table:
    total, places = _merged(table)
    return pa.table(
        {
            "chunk": table.column("chunk"),
            "n": table.column("n"),
            "bucket": table.column("bucket"),
            "counts": pa.array([_small(total[p]) for p in places], pa.binary()),
        }
    )


def answers(asked: DataFrame) -> DataFrame:
    """Every chunk's rows, with the counts of all chunks instead of its own."""
    return asked.groupBy("bucket").applyInArrow(_back, ANSWERED)


def totals(asked: DataFrame) -> DataFrame:
    """(total, distinct) for each bucket: summed counts, and keys with a count above 0."""

    def one(table: pa.Table) -> pa.Table:
        total, _ = _merged(table)
        return pa.table({"total": [int(total.sum())], "distinct": [int((total > 0).sum())]})

    return asked.groupBy("bucket").applyInArrow(one, "total long, distinct long")


def answered(table: pa.Table, n: int) -> np.ndarray:
    """A chunk's counts for kind ``n``, in the order of the keys that it asked for."""
    rows = [r for r in zip(*(table.column(c).to_pylist() for c in ("n", "bucket", "counts"))) if r[0] == n]
    parts = [_large(raw) for _, _, raw in sorted(rows, key=lambda r: r[1])]
    return np.concatenate([np.zeros(0, np.int64), *parts])

