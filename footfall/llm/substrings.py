"""Long passages repeated across documents, by a compacted sparse de Bruijn graph.

Every run of ``size`` words (a token k-mer) is an edge. Each window of ``span`` words
picks the edge of least hash in it, so equal windows pick equal edges, and only picked
edges become rows, about one in twenty. Consecutive windows that pick the same edge
are one path: all the words they cover, which go on to the left and right of the edge
as long as nothing else is picked.

Paths compact by joins. Equal paths are one row, whatever the number of their copies,
that knows the smallest document. An edge whose occurrences all lie on one path does
not branch: whatever holds it holds the whole path, and in all documents but the
smallest the path's words go. Where an edge branches into several paths, the words at
the source coordinates of each path's smallest document are read again and its windows
are told apart one by one.

Equal words have equal 64-bit hashes; paths and windows are compared by two such
numbers of different words' values (the edge's and their own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.textbytes import mix, row_groups, word_hashes
from footfall.plans.scratch import Scratch

SPAN = 50  # words in a window
SIZE = 12  # words in an edge
_GROUP = 1 << 20  # bytes of text looked at together; a longer text stands alone
_BLOCK = 1 << 18  # windows of one text looked at together
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_OTHER = np.uint64(0xD1B54A32D192ED03)


class _Prefixes:
    """Hashes of any stretch of words in constant time, from sums of words times powers."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words) + 1
        self._inverse = self._powers(_INVERSE, n)
        self._sums = np.zeros(n, np.uint64)
        np.cumsum(words * self._powers(_BASE, n)[:-1], out=self._sums[1:])

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def hashes(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        own = (self._sums[ends] - self._sums[begins]) * self._inverse[begins]
        return mix(own + (ends - begins).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the leftmost smallest of each ``width`` consecutive values is."""
    best, seen = np.arange(len(values)), 1
    while seen < width:
        step = min(seen, width - seen)
        left, right = best[:-step], best[step:]
        best = np.where(values[left] <= values[right], left, right)
        seen += step
    return best


def _starts(bounds: np.ndarray, span: int) -> np.ndarray:
    """Where the windows of all rows begin."""
    many = np.maximum(np.diff(bounds) - span + 1, 0)
    before = np.cumsum(many) - many
    return np.arange(many.sum()) - np.repeat(before - bounds[:-1], many)


def paths_in(
    words: np.ndarray, bounds: np.ndarray, span: int, size: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(edge, path, first window, number of windows) of each path, by word positions.

    Rows of more than _BLOCK windows are cut between windows; where they are cut does
    not change what is found, only how many paths tell it.
    """
    starts = _starts(bounds, span)
    for cut in range(0, len(starts), _BLOCK):
        own = starts[cut : cut + _BLOCK]
        base, end = own[0], own[-1] + span
        part = words[base:end]
        edges = np.arange(len(part) - size + 1)
        hashes = _Prefixes(part).hashes(edges, edges + size)
        picked = _least(hashes, span - size + 1)[own - base]
        new = np.concatenate([[0], np.flatnonzero(np.diff(picked)) + 1])
        first = own[new]
        many = np.diff(new, append=len(own))
        path = _Prefixes(mix(part ^ _OTHER)).hashes(first - base, first - base + many - 1 + span)
        yield hashes[picked[new]], path, first, many


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _occurrences(docs: DataFrame, span: int, size: int) -> DataFrame:
    """(doc_id, text_hash, edge, path, first, many) of each path in each row with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_groups(batch, "text", _GROUP):
                words, bounds = word_hashes(part.column("text"), fold=False)
                for edge, path, first, many in paths_in(words, bounds, span, size):
                    row = np.searchsorted(bounds, first, "right") - 1
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id").take(at),
                            part.column("text_hash").take(at),
                            _signed(edge),
                            _signed(path),
                            pa.array(first - bounds[row]),
                            pa.array(many),
                        ],
                        names=["doc_id", "text_hash", "edge", "path", "first", "many"],
                    )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"doc_id {id_type}, text_hash long, edge long, path long, first long, many long"
    )


def _windows(docs: DataFrame, span: int) -> DataFrame:
    """(doc_id, text_hash, edge, win, at) of each window of the paths listed in ``checked``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_groups(batch, "text", _GROUP):
                words, bounds = word_hashes(part.column("text"), fold=False)
                prefixes = _Prefixes(mix(words ^ _OTHER))
                lists = part.column("checked")
                row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                paths = lists.flatten()
                many = paths.field("many").to_numpy()
                for cut in range(0, len(many), _BLOCK // span):
                    some = slice(cut, cut + _BLOCK // span)
                    n = many[some]
                    begins = np.repeat(paths.field("first").to_numpy()[some], n)
                    at = begins + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    rows = np.repeat(row[some], n)
                    place = at + bounds[rows]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id").take(pa.array(rows)),
                            part.column("text_hash").take(pa.array(rows)),
                            pa.array(np.repeat(paths.field("edge").to_numpy()[some], n)),
                            _signed(prefixes.hashes(place, place + span)),
                            pa.array(at),
                        ],
                        names=["doc_id", "text_hash", "edge", "win", "at"],
                    )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"doc_id {id_type}, text_hash long, edge long, win long, at long"
    )


def repeats(docs: DataFrame, scratch: Scratch, span: int = SPAN, size: int = SIZE) -> DataFrame:
    """(doc_id, text_hash, first, stop): stretches of words that repeat a smaller document's.

    A stretch is what some windows cover that also begin in a document with a smaller
    ``doc_id``. Stretches of one row may overlap. ``text_hash`` is Spark's xxhash64 of
    the text and tells rows apart that share an id.
    """
    texts = docs.where("doc_id IS NOT NULL").select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash")
    )
    found = scratch.keep(_occurrences(texts, span, size), "paths")
    low, high = F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    # Edges of one document only are most of all; they go first. What rows are joined to
    # is written before, so that a join of rows with one very common edge can be split.
    shared = scratch.keep(
        found.groupBy("edge").agg(low, high).where("low < high").select("edge"), "edges"
    )
    occurring = scratch.keep(found.join(shared, "edge", "left_semi"), "shared")
    paths = scratch.keep(occurring.groupBy("edge", "path").agg(low, high), "distinct")
    branches = scratch.keep(
        paths.groupBy("edge").agg(F.count(F.lit(1)).alias("branches")), "branches"
    )
    known = scratch.keep(
        paths.join(branches, "edge")
        .where("low < high OR branches > 1")
        .select("edge", "path", "low", "branches"),
        "known",
    )
    placed = scratch.keep(occurring.join(known, ["edge", "path"]), "placed")
    whole = placed.where("doc_id > low").select(
        "doc_id", "text_hash", "first", (F.col("first") + F.col("many") - 1 + span).alias("stop")
    )
    checked = (
        placed.where("doc_id = low AND branches > 1")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("edge", "first", "many")).alias("checked"))
    )
    windows = scratch.keep(_windows(texts.join(checked, ["doc_id", "text_hash"]), span), "windows")
    smallest = scratch.keep(
        windows.groupBy("edge", "win").agg(low, high).where("low < high").drop("high"), "smallest"
    )
    single = (
        windows.join(smallest, ["edge", "win"])
        .where("doc_id > low")
        .select("doc_id", "text_hash", F.col("at").alias("first"), (F.col("at") + span).alias("stop"))
    )
    return whole.unionByName(single)


_ADDED = ("n_words", "n_removed", "kept_text")


def without_repeats(
    docs: DataFrame, scratch: Scratch, span: int = SPAN, size: int = SIZE
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``: the words that stay.

    Every row stays, also repeated ones. A word goes if a window of ``span`` words that
    covers it also begins in a document with a smaller ``doc_id``; windows are judged
    on the texts as they came. Rows that share an id do not repeat each other. A row
    without an id takes no part: it loses nothing, and nothing is lost to it. Null
    texts have no words, and ``kept_text`` is then empty. Columns named like the added
    ones, in any case, are replaced.
    """
    lists = (
        repeats(docs, scratch, span, size)
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.collect_set(F.struct("first", "stop")).alias("_gone"))
    )
    own = [c for c in docs.columns if c.lower() not in _ADDED]
    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    joined = docs.select(own).join(lists, same, "left").select(*own, "_gone")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(own).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_groups(batch, "text", _GROUP):
                n_words, n_removed, kept = [], [], []
                for text, gone in zip(part.column("text"), part.column("_gone")):
                    words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                    n_words.append(len(words))
                    if gone.is_valid and len(gone):
                        edges = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edges, gone.values.field("first").to_numpy(), 1)
                        np.add.at(edges, gone.values.field("stop").to_numpy(), -1)
                        stays = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
                        words = [words[i] for i in stays.tolist()]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in own),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(kept, pa.string()),
                    ],
                    names=[*own, *_ADDED],
                )

    return joined.mapInArrow(
        run, ", ".join([*fields, "n_words long", "n_removed long", "kept_text string"])
    )
