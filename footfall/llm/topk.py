"""Exact highest inner products without random access.

Every component is a list of the candidates, sorted. All lists are read from the
end that helps a query most, some depth at a time. What was read gives each
candidate a lower and an upper bound of its score; the next unread value of a list
bounds what it can still add. Reading stops when no candidate outside a few that are
kept can reach the k-th lower bound, and only those are then scored in full.

Candidates and queries meet in blocks, so that a task holds one block of each. Lists
are sorted once a block. The first block tells each query a k-th best score, and no
list of another block is read further than it takes to fall short of that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 1024  # candidates in a block, about
QUERY_BLOCK = 512
SCALE = 256
_EXACT = float(1 << 52)  # doubles hold all integers up to here
_LEAST = np.iinfo(np.int64).min // 2
_STEPS = 16  # from the middle on, lists are read by this part of them at a time


def scaled(embedding: Column) -> Column:
    """``floor(256 * x)`` of every component."""
    return F.transform(embedding, lambda x: F.floor(F.lit(SCALE) * x.cast("double")))


def usable(embedding: Column) -> Column:
    """Whether a vector is there and holds finite numbers only."""
    finite = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.coalesce(embedding.isNotNull() & finite, F.lit(False))


def list_places(vectors: np.ndarray) -> np.ndarray:
    """Where each component of each vector stands in its sorted list."""
    return vectors.argsort(axis=0, kind="stable").argsort(axis=0, kind="stable").astype(np.int32)


def best_by_lists(
    ids: np.ndarray,
    vectors: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    k: int,
    places: np.ndarray | None = None,
    floors: np.ndarray | None = None,
    read: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of the ``k`` best of every query, ties to small ids.

    ``places`` are the vectors' ``list_places``, if known. ``floors`` are scores that a
    query's ``k`` best elsewhere reach at least: rows below them may be left out. The
    share of the lists that each query had read goes to ``read``.
    """
    n, dims = vectors.shape
    largest = max(np.abs(vectors).max(initial=0), 1) * float(np.abs(queries).max(initial=0))
    kind = np.float64 if largest * max(dims, 1) < _EXACT else np.int64
    vectors, queries = vectors.astype(kind), queries.astype(kind)
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    ranks = list_places(vectors) if places is None else places
    lists = np.empty_like(vectors)
    np.put_along_axis(lists, ranks.astype(np.int64), vectors, axis=0)
    own = ids[:, None] == query_ids[None, :]
    known = np.full(len(queries), _LEAST) if floors is None else floors
    active = np.arange(len(queries))
    partial = np.zeros((n, len(queries)), kind)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    depth, step = 0, max(n // _STEPS, 4 * k, 1)
    few = max(8 * k, n // 16)  # so many are scored in full rather than read on for
    while len(active):
        # Twice as far as before, but from the middle on by equal parts.
        before, depth = depth, min(n, depth + max(min(depth, n // 2 - depth), step))
        # Entries read now: of the upper ends for positive weights, of the lower for others.
        top, bottom = ranks >= n - depth, ranks < depth
        new_top, new_bottom = top & (ranks < n - before), bottom & (ranks >= before)
        up, down = plus[active], minus[active]
        partial = partial + (vectors * new_top) @ up.T + (vectors * new_bottom) @ down.T
        rest = slice(None) if depth < n else slice(0, 0)
        next_top, next_bottom = lists[max(n - depth - 1, 0)], lists[min(depth, n - 1)]
        upper, lower = partial.copy(), partial.copy()
        for unread, weights, bound, worst in (
            (~top, up, next_top, lists[0]),
            (~bottom, down, next_bottom, lists[-1]),
        ):
            upper[rest] += (unread.astype(kind) @ (weights * bound).T)[rest]
            lower[rest] += (unread.astype(kind) @ (weights * worst).T)[rest]
        upper[own[:, active]] = _LEAST
        lower[own[:, active]] = _LEAST
        floor = np.partition(lower, max(n - k, 0), axis=0)[max(n - k, 0)]
        floor = np.maximum(floor, known[active])
        unseen = (up * next_top).sum(axis=1) + (down * next_bottom).sum(axis=1)
        left = (upper >= floor).sum(axis=0)
        done = (unseen < floor) & (left <= few) if depth < n else np.ones(len(active), bool)
        for column in np.flatnonzero(done):
            rows = np.flatnonzero((upper[:, column] >= floor[column]) & ~own[:, active[column]])
            found.append((np.full(len(rows), active[column]), rows))
        if read is not None:
            read[active[done]] = depth / n
        active, partial = active[~done], partial[:, ~done]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    which, rows = (np.concatenate(x) for x in zip(*found))
    score = np.einsum("ij,ij->i", vectors[rows], queries[which]).astype(np.int64)
    order = np.lexsort((ids[rows], -score, which))
    which, rows, score = which[order], rows[order], score[order]
    first = np.searchsorted(which, which, "left")
    best = np.arange(len(which)) - first < k
    return which[best], rows[best], score[best]


def _blocks(rows: DataFrame, groups: int) -> DataFrame:
    """Rows of one dimension and group as one binary row: ids, copies, components and their places."""

    def one(table: pa.Table) -> pa.Table:
        dims = table.column("dims")[0].as_py()
        data = table.column("v").combine_chunks().flatten().to_numpy().astype(np.int64)
        return pa.table(
            {
                "dims": table.column("dims")[:1],
                "part": table.column("part")[:1],
                "ids": [table.column("vec_id").to_numpy().tobytes()],
                "copies": [table.column("copies").to_numpy().tobytes()],
                "data": [data.tobytes()],
                "places": [list_places(data.reshape(-1, dims)).tobytes() if dims else b""],
            }
        )

    keyed = rows.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups)))
    return keyed.groupBy("dims", "part").applyInArrow(
        one, "dims int, part long, ids binary, copies binary, data binary, places binary"
    )


def _numbers_below(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _numbers(row: dict, name: str, dims: int, many: int, kind=np.int64) -> np.ndarray:
    raw = np.frombuffer(row[name], kind)
    return raw.reshape(-1, dims) if dims else np.zeros((many, 0), kind)


def _best(row: dict, k: int) -> tuple[np.ndarray, ...]:
    """Ids, copies and components of a pair of blocks, and its best rows."""
    ids, query_ids, copies = (
        np.frombuffer(row[name], np.int64) for name in ("ids", "query_ids", "copies")
    )
    data = _numbers(row, "data", row["dims"], len(ids))
    query_data = _numbers(row, "query_data", row["dims"], len(query_ids))
    places = _numbers(row, "places", row["dims"], len(ids), np.int32)
    floors = np.frombuffer(row["floors"], np.int64) if row["floors"] else None
    found = best_by_lists(ids, data, query_ids, query_data, k, places, floors)
    return ids, copies, query_ids, query_data, *found


def _with_floors(queries: DataFrame, blocks: DataFrame, groups: int, k: int) -> DataFrame:
    """Query blocks with ``floors``: a score that each query's ``k`` best reach, from the first block.

    There is a copy of that block for each of the ``groups`` of queries, so they meet in
    as many tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors: list[bytes | None] = []
            for row in batch.to_pylist():
                if row["ids"] is None:
                    floors.append(None)
                    continue
                _, copies, query_ids, _, which, at, score = _best(row, k)
                rows = np.bincount(which, np.minimum(copies[at], k), len(query_ids))
                least = np.full(len(query_ids), np.iinfo(np.int64).max)
                np.minimum.at(least, which, score)
                floors.append(np.where(rows >= k, least, _LEAST).tobytes())
            names = ["dims", "query_ids", "query_data"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(floors, pa.binary())],
                names=[*names, "floors"],
            )

    first = blocks.where("part = 0").withColumn("part", F.explode(_numbers_below(groups)))
    met = queries.withColumn("floors", F.lit(None).cast("binary")).join(
        first, ["dims", "part"], "left"
    )
    return met.mapInArrow(run, "dims int, query_ids binary, query_data binary, floors binary")


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """Each query's ``k`` best other rows: query_id, rank from 1, vec_id, score.

    ``vectors`` has vec_id and embedding; ``is_query`` says which rows are queries.
    Rows with a null vec_id, a null vector or a null or non-finite component take
    no part. Rows with a query's own vec_id are not its candidates; other rows that
    repeat are candidates each. A repeated query is asked once. Only vectors of the
    same length meet. Fewer than ``k`` candidates give fewer rows, an empty table
    none. Scores are exact while they fit 64 bits.
    """
    rows = (
        vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            scaled(F.col("embedding")).alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("asked"),
        )
        .groupBy("vec_id", "v")
        .agg(F.count(F.lit(1)).alias("copies"), F.max("asked").alias("asked"))
        .withColumn("dims", F.size("v"))
    )
    total = vectors.count()
    groups = 1 + total // BLOCK
    asked = rows.where("asked")
    query_groups = 1 + vectors.where(is_query).count() // QUERY_BLOCK
    blocks = _blocks(rows.drop("asked"), groups)
    queries = _blocks(asked.drop("asked"), query_groups).select(
        "dims", "part", F.col("ids").alias("query_ids"), F.col("data").alias("query_data")
    )
    if groups > 1:
        queries = _with_floors(queries, blocks, query_groups, k)
    else:
        queries = queries.withColumn("floors", F.lit(None).cast("binary"))
    every = queries.withColumn("part", F.explode(_numbers_below(groups)))
    pairs = blocks.join(every, ["dims", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, copies, query_ids, query_data, which, at, score = _best(row, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(query_ids[which]),
                        # One id may stand for queries with different vectors.
                        pa.array(_fingerprints(query_data)[which]),
                        pa.array(ids[at]),
                        pa.array(score),
                        pa.array(np.minimum(copies[at], k)),
                    ],
                    names=["query_id", "vector", "vec_id", "score", "copies"],
                )

    best = pairs.mapInArrow(run, "query_id long, vector long, vec_id long, score long, copies long")
    each = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    order = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    return (
        each.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _fingerprints(rows: np.ndarray) -> np.ndarray:
    """A number for each row's components."""
    factors = np.random.default_rng(7).integers(1, 1 << 62, rows.shape[1], np.int64)
    return (rows * factors).sum(axis=1, dtype=np.int64)
