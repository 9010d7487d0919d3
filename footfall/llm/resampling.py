"""Importance resampling: draws the documents that look most like a target table.

Texts become counts of hashed word n-grams. A bucket's gain is the log ratio of its
smoothed shares in the target and in the documents; a document's weight is the mean
gain of its features, and weights plus Gumbel noise give a sample without replacement
in one ordering.

A batch's texts are joined with a separator that no word can hold, so that one pass
of one pattern finds the words of all of them. Where a word begins tells its row, and
n-grams whose first and last word lie in different rows are masked.

Nulls, empty texts and texts without words have no features and weight 0; a null id
draws the noise of an empty one and comes last among equals. Rows that share an id
share their noise and are ranked by number of features, then as they come. Without
target texts all buckets have no target count; without documents there are no rows.
Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.llm.textbytes import row_groups, string_bytes
from footfall.plans.scratch import Scratch

# Lower-case letters, digits and every byte of a non-ASCII character.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SEPARATOR = b"\n"
_WORDS = 1 << 16  # looked at together
_GROUP = 1 << 22  # bytes of text joined together; a longer text stands alone


def features(
    texts: pa.Array, orders: tuple[int, int], buckets: int
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(row, bucket) of each feature and the words' number, for some words of all texts at a time.

    ``orders`` are the least and the greatest number of words in a feature.
    """
    data, offsets = string_bytes(texts)
    raw = memoryview(data)
    joined = _SEPARATOR.join([raw[a:b] for a, b in zip(offsets, offsets[1:])]).lower()
    begins = offsets[:-1] - offsets[0] + np.arange(len(offsets) - 1) * len(_SEPARATOR)
    matches = _WORD.finditer(joined)
    words: list[bytes] = []
    rows = np.zeros(0, np.int64)
    while block := list(islice(matches, _WORDS)):
        # The last words before go along, for n-grams that began there.
        kept = min(len(words), orders[1] - 1)
        words = words[len(words) - kept :] + [m.group() for m in block]
        starts = np.fromiter((m.start() for m in block), np.int64, len(block))
        new = np.searchsorted(begins, starts, "right") - 1
        rows = np.concatenate([rows[len(rows) - kept :], new])
        spaced = [b" " + w for w in words] if orders[1] > 1 else []
        hashes: list[int] = []
        found_rows, found = [], []
        for n in range(1, orders[1] + 1):
            hashes = list(map(crc32, words)) if n == 1 else list(map(crc32, spaced[n - 1 :], hashes))
            if n < orders[0]:
                continue
            first = max(kept - n + 1, 0)  # earlier ones ended in the block before
            own = rows[first : len(hashes)]
            whole = own == rows[first + n - 1 : len(hashes) + n - 1]
            found_rows.append(own[whole])
            found.append(np.array(hashes[first:], np.int64)[whole] % buckets)
        yield np.concatenate([np.zeros(0, np.int64), *found_rows]), np.concatenate(
            [np.zeros(0, np.int64), *found]
        ), new


def bucket_counts(texts: DataFrame, orders: tuple[int, int], buckets: int) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket; at most one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in row_groups(batch, "text", _GROUP):
                for _, found, _ in features(part.column("text"), orders, buckets):
                    total += np.bincount(found, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hit, pa.int64()), pa.array(total[hit], pa.int64())], names=["bucket", "n"]
        )

    each = texts.select("text").mapInArrow(run, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of every bucket's smoothed shares, rounded down."""
    buckets = len(source)
    above = (target + 1.0) * (source.sum() + buckets)
    below = (source + 1.0) * (target.sum() + buckets)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def _collected(counts: DataFrame, buckets: int) -> np.ndarray:
    """One number a bucket, on the driver."""
    table = counts.toArrow()
    out = np.zeros(buckets, np.int64)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def weights(docs: DataFrame, gain: np.ndarray, orders: tuple[int, int]) -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_groups(batch, "text", _GROUP):
                n_words, n_features, total = np.zeros((3, part.num_rows), np.int64)
                for rows, found, words in features(part.column("text"), orders, len(gain)):
                    n_words += np.bincount(words, minlength=part.num_rows)
                    n_features += np.bincount(rows, minlength=part.num_rows)
                    # Sums of whole numbers far below 2**53 are exact.
                    total += np.bincount(rows, gain[found], part.num_rows).astype(np.int64)
                weight = total // np.maximum(n_features, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        *(pa.array(c, pa.int64()) for c in (n_words, n_features, weight)),
                    ],
                    names=["doc_id", "text_hash", "n_words", "n_features", "weight"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run,
        f"doc_id {id_type}, text_hash long, n_words long, n_features long, weight long",
    )


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of standard Gumbel noise from a hash of the id, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.substring(F.sha2(key, 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.ln(-F.ln(share))).cast("long")


def ranked(scored: DataFrame, allowed: Column, percent: int, scratch: Scratch) -> DataFrame:
    """``scored`` with ``rank`` for the ``percent`` of its allowed rows that score highest.

    Scores are whole numbers of a narrow range (some 100 000 values at most, as gains
    and noise are logarithms), so their histogram is small and gives the lowest score
    drawn. Rows from there on are dealt over ranges of their order, and a row's rank is
    the sizes of the ranges before its own plus its place there; no task orders all.
    ``scored`` is a written table.
    """
    histogram = scored.where(allowed).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    size = F.call_function("div", F.sum("n").over(Window.partitionBy()) * percent, F.lit(100))
    steps = histogram.select("score", before.alias("before"), size.alias("size"))
    cut = steps.where("before < size").agg(F.min("score"), F.max("size")).first()
    none = F.lit(None).cast("long")
    if cut[0] is None:
        return scored.withColumn("rank", none)
    near = allowed & (F.col("score") >= F.lit(cut[0]))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("row")]
    top = scratch.keep(
        scored.where(near).repartitionByRange(*order).withColumn("range", F.spark_partition_id()),
        "top",
    )
    sizes = top.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    first = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("range", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("begin"))
    place = F.col("begin") + F.row_number().over(Window.partitionBy("range").orderBy(*order))
    placed = top.join(begins, "range").withColumn("rank", place)
    within = F.when(F.col("rank") <= cut[1], F.col("rank"))
    return (
        placed.select(*scored.columns, within.alias("rank"))
        .unionByName(scored.where(~near).withColumn("rank", none))
    )


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    scratch: Scratch,
    orders: tuple[int, int] = (1, 2),
    buckets: int = 10000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight, score, rank) of each document.

    ``rank`` is null unless the row is among the ``percent`` of those with at least
    ``least_words`` words that are drawn.
    """
    source_counts = _collected(bucket_counts(docs, orders, buckets), buckets)
    gain = gains(source_counts, _collected(bucket_counts(target, orders, buckets), buckets))
    scored = weights(docs, gain, orders).withColumns(
        {
            "score": F.col("weight") + gumbel(F.col("doc_id"), seed),
            "row": F.monotonically_increasing_id(),
        }
    )
    kept = scratch.keep(scored, "scored")
    return ranked(kept, F.col("n_words") >= least_words, percent, scratch).drop("row")


def drawn(docs: DataFrame, ranks: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``importance_ranks`` drew, as they are."""
    chosen = ranks.where("rank IS NOT NULL").select(
        F.col("doc_id").alias("_drawn_id"), F.col("text_hash").alias("_drawn_hash")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_drawn_id")) & (
        F.xxhash64("text") == F.col("_drawn_hash")
    )
    return docs.join(chosen, same, "left_semi")
