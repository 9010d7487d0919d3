"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. For each bit one binary classifier over
hashed byte trigrams tells the languages whose codeword has a 1 there from those
that have a 0. A text's language is the codeword with the smallest summed loss of
all bits, so a few bits that are wrong do no harm. Two codewords that are nearly
as close flag the text as ambiguous.

Learning is one pass over all labelled texts: each counts with weight 1, whatever
its length, and a task hands on at most BUCKETS sums for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.textbytes import PIECE, row_groups, string_bytes

BUCKETS = 1 << 14  # hashed trigrams
SMOOTHING = 0.05  # of one text's weight, spread over all buckets
SHARPNESS = 2.0  # turns a mean log-odds into a margin
AMBIGUOUS = 0.5  # a second codeword within this loss makes a text ambiguous
UNKNOWN = "und"
_GROUP = 1 << 22  # bytes of text looked at together

_LETTER = np.zeros(256, np.uint32)
_LETTER[ord("a") : ord("z") + 1] = np.arange(1, 27)
_LETTER[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_LETTER[128:] = np.arange(128, 256)


def _trigrams(data: np.ndarray) -> np.ndarray:
    """The bucket of the trigram at every byte but the last two; 0 if it has no letter."""
    x = _LETTER[data]
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - 14)
    return np.where(code == 0, 0, bucket).astype(np.int64)


def _stretches(
    data: np.ndarray, offsets: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Trigram buckets and the rows they belong to, some megabytes at a time.

    Two spaces are put around every row so that its edges count as well.
    """
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        if last == first + 1 and offsets[last] - offsets[first] > PIECE:
            own = data[offsets[first] : offsets[last]]
            edge = np.full(2, 0x20, np.uint8)
            for at in range(0, len(own), PIECE):
                before = own[max(at - 2, 0) : at] if at else edge
                after = edge if at + PIECE >= len(own) else edge[:0]
                bucket = _trigrams(np.concatenate([before, own[at : at + PIECE], after]))
                yield bucket, np.full(len(bucket), first)
        else:
            sizes = np.diff(offsets[first : last + 1])
            rows = np.repeat(np.arange(first, last), sizes + 2)
            spaced = np.full(len(rows) + 2, 0x20, np.uint8)
            places = np.arange(offsets[first], offsets[last]) - offsets[first]
            spaced[2 + places + 2 * np.repeat(np.arange(last - first), sizes)] = data[
                offsets[first] : offsets[last]
            ]
            yield _trigrams(spaced), rows
        first = last


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages.

    Up to six languages get all distinct splits in two; more get, of some dense
    random codes with a fixed seed, the one whose closest rows differ the most.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 6:
        splits = np.arange(1, 1 << (n - 1))
        return np.array([np.where(splits >> row & 1, 1.0, -1.0) for row in range(n)])
    length = int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (n, length))
        code = code[:, np.abs(code.sum(axis=0)) < n]  # a bit must tell something apart
        distance = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * length
        if distance.min() > apart:
            best, apart = code, distance.min()
    return best


@dataclass(frozen=True)
class LanguageModel:
    """languages: names, sorted; code: their codewords; weights: log-odds by bucket and bit."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language, its share of belief from 0 to 1, and whether it is ambiguous."""
        data, offsets = string_bytes(column)
        n = len(offsets) - 1
        sums, seen = np.zeros((n, self.weights.shape[1])), np.zeros(n)
        for bucket, rows in _stretches(data, offsets):
            bucket_weights = self.weights[bucket]
            edges = np.flatnonzero(np.diff(rows, prepend=-1))
            sums[rows[edges]] += np.add.reduceat(bucket_weights, edges, axis=0)
            seen[rows[edges]] += np.add.reduceat((bucket != 0).astype(np.float64), edges)
        margins = SHARPNESS * sums / np.maximum(seen, 1)[:, None]
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None]).sum(axis=2)
        ranked = np.sort(loss, axis=1)
        best = loss.argmin(axis=1)
        share = np.exp(ranked[:, :1] - loss).sum(axis=1)
        close = (
            ranked[:, 1] - ranked[:, 0] < AMBIGUOUS
            if len(self.languages) > 1
            else np.zeros(n, bool)
        )
        letters = has_letter(data, offsets)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
        return names, np.where(letters, 1 / share, 0.0), close & letters


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row has a letter; only rows without an ASCII one are decoded."""
    out = np.zeros(len(offsets) - 1, bool)
    for i in range(len(out)):
        own = data[offsets[i] : offsets[i + 1]]
        for at in range(0, len(own), 4096):
            codes = _LETTER[own[at : at + 4096]]
            if ((codes > 0) & (codes < 128)).any():
                out[i] = True
                break
        else:
            if (own >= 128).any():
                out[i] = any(map(str.isalpha, own.tobytes().decode("utf-8", "replace")))
    return out


def _language_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, share): the task's summed trigram shares; bucket -1 has the number of texts."""
    texts: dict[str, int] = {}
    sums: dict[str, np.ndarray] = {}
    for batch in (part for whole in batches for part in row_groups(whole, "text", _GROUP)):
        data, offsets = string_bytes(batch.column("text"))
        names = batch.column("lang").to_pylist()
        for name in names:
            texts[name] = texts.get(name, 0) + 1
            sums.setdefault(name, np.zeros(BUCKETS))
        index = {name: i for i, name in enumerate(sums)}
        row_language = np.array([index[name] for name in names], np.int64)
        total = np.zeros(len(names))
        for bucket, rows in _stretches(data, offsets):
            total += np.bincount(rows[bucket != 0], minlength=len(names))
        share = 1 / np.maximum(total, 1)
        flat = np.zeros(len(index) * BUCKETS)
        for bucket, rows in _stretches(data, offsets):
            keep = bucket != 0
            where = row_language[rows[keep]] * BUCKETS + bucket[keep]
            flat += np.bincount(where, weights=share[rows[keep]], minlength=len(flat))
        for name, i in index.items():
            sums[name] += flat[i * BUCKETS : (i + 1) * BUCKETS]
    for name, own in sums.items():
        hit = np.flatnonzero(own)
        yield pa.record_batch(
            {
                "lang": pa.array([name] * (len(hit) + 1), pa.string()),
                "bucket": pa.array([-1, *hit.tolist()], pa.int32()),
                "share": np.concatenate([[float(texts[name])], own[hit]]),
            }
        )


def fit_languages(examples: DataFrame) -> LanguageModel:
    """Learns from every row of ``examples`` (text, lang); rows with a null are left out.

    Tasks' sums meet by language and bucket, added up before and after the shuffle, so
    no task reads the vectors of all others. The driver gets one vector of BUCKETS
    numbers for each language. Without any row the model knows no language and
    predicts ``und`` for all.
    """
    sums = (
        examples.select("text", "lang")
        .where(F.col("text").isNotNull() & F.col("lang").isNotNull())
        .mapInArrow(_language_sums, "lang string, bucket int, share double")
        .groupBy("lang", "bucket")
        .agg(F.sum("share").alias("share"))
        .toArrow()
    )
    found = sorted(set(sums.column("lang").to_pylist()))
    if not found:
        return LanguageModel((UNKNOWN,), codewords(1), np.zeros((BUCKETS, 1), np.float32))
    row = np.searchsorted(np.array(found, object), sums.column("lang").to_numpy())
    shares = np.zeros((len(found), BUCKETS + 1))
    shares[row, sums.column("bucket").to_numpy()] = sums.column("share").to_numpy()
    code = codewords(len(found))
    # A language's trigram shares, whatever its number of texts.
    shares = shares[:, :-1] / shares[:, -1:] + SMOOTHING / BUCKETS
    ones, zeros = (code > 0).astype(float), (code < 0).astype(float)
    positive = ones.T @ shares / np.maximum(ones.sum(axis=0), 1)[:, None]
    negative = zeros.T @ shares / np.maximum(zeros.sum(axis=0), 1)[:, None]
    floor = SMOOTHING / BUCKETS
    weights = np.log(np.maximum(positive, floor)) - np.log(np.maximum(negative, floor))
    weights[:, 0] = 0
    return LanguageModel(
        tuple(found), code, weights.T.astype(np.float32).copy()
    )


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``lang_ambiguous``.

    A null text, or one without a letter, is ``und`` with score 0 and not
    ambiguous. Columns of these names in ``docs`` are replaced; all other columns
    and rows stay as they are, repeated rows too.
    """
    added = ("lang_pred", "lang_score", "lang_ambiguous")
    docs = docs.drop(*added)
    schema = ", ".join(
        [
            *(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
            "lang_pred string, lang_score double, lang_ambiguous boolean",
        ]
    )
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_groups(batch, "text", _GROUP):
                names, score, close = model.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(score), pa.array(close)],
                    names=[*part.schema.names, *added],
                )

    return docs.mapInArrow(run, schema)
