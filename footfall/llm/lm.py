"""Language-model scores of texts by a weighted backoff automaton.

The model is a Dirichlet-smoothed n-gram model over all training texts: after a context u
that was seen, word w has probability (c(u w) + MASS * p(w | u')) / (c(u) + MASS), where u'
is u without its first word, and p(w) without any context is the add-one share of w. As an
automaton, every seen context of up to ``order - 1`` words is a state. A seen n-gram is an
arc with its probability, to the longest state that it ends with; for any other word the
state's failure arc, of weight MASS / (c(u) + MASS), leads to the state of u', and at last
to the root, whose arcs hold p(w) for all words. A text is scored in one traversal that
carries the state and adds up logarithms. The state after a token is the longest one that
ends there, so all tokens of some texts follow their arcs together, and those without an
arc go on along their failure arcs, of which there are at most ``order - 1``.

Counts grow with the corpus, so no task holds them all. Texts are dealt over chunks.
A chunk sends its distinct n-grams to the buckets of a hash, where all chunks'
counts are added up, and gets back the counts of just its own: the part of the
automaton that its texts can reach. All n-grams are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm import counting
from footfall.llm.textbytes import mix, row_groups, word_hashes

MASS = 4.0  # how many counts the lower order stands for
ORDER = 2  # words in the longest n-gram
CHUNK = 4 << 20  # bytes of text in a chunk, about
END = np.uint64(0x1D872B41C0FFEE11)  # the token after a text's last word
START = np.uint64(0x6C62272E07BB0142)  # the state before its first; no token


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every row's words and END, and where each row's begin."""
    words, bounds = word_hashes(column)
    n = len(bounds) - 1
    out_bounds = bounds + np.arange(n + 1)
    out = np.full(int(out_bounds[-1]), END, np.uint64)
    rows = np.repeat(np.arange(n), np.diff(bounds))
    out[np.arange(len(words)) + rows] = words
    return out, out_bounds


def _grams(tokens: np.ndarray, bounds: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n from 1: the hash of the n-gram that ends at each token, and whether there is one.

    START stands before a text's first token and is part of n-grams from there on.
    """
    place = np.arange(len(tokens)) - np.repeat(bounds[:-1], np.diff(bounds))
    keys = [(tokens, np.ones(len(tokens), bool))]
    for n in range(2, order + 1):
        before = np.empty_like(tokens)
        before[1:] = keys[-1][0][:-1]
        if n == 2:
            before[bounds[:-1]] = START
        there = place >= n - 2
        keys.append((np.where(there, mix(before * np.uint64(3) ^ mix(tokens)), np.uint64(0)), there))
    return keys


class Automaton:
    """States and arcs, from the counts of the n-grams that end at each token of some texts.

    State 0 is the root and 1 the start of a text; words are numbered from 0. ``root`` is
    each word's log10 p.
    """

    def __init__(
        self,
        word: np.ndarray,
        bounds: np.ndarray,
        root: np.ndarray,
        grams: list[tuple[np.ndarray, np.ndarray]],
        counts: list[np.ndarray],
        starts: int,
    ) -> None:
        """counts: for each n, the training count of the n-gram that ends at each token."""
        order, words = len(grams), len(root)
        first, last = bounds[:-1], bounds[1:] - 1
        self._words, self._root = words, root
        fail, fail_to = [0.0, _fail(starts)], [0, 0]
        state = [np.zeros(len(word), np.int64)]  # by n: the state that ends at each token
        arc_keys, weights, targets = [], [], []
        for n in range(1, order):
            own = (counts[n - 1] > 0) & grams[n - 1][1]
            own[last] = False  # nothing follows a text's end
            _, at, which = np.unique(grams[n - 1][0][own], return_index=True, return_inverse=True)
            at = np.flatnonzero(own)[at]
            found = np.zeros(len(word), np.int64)
            found[own] = len(fail) + which
            fail += np.log10(MASS / (counts[n - 1][at] + MASS)).tolist()
            fail_to += state[n - 1][at].tolist()
            state.append(found)
        p = 10 ** root[word]
        for n in range(2, order + 1):
            before = np.zeros(len(word), np.int64)
            before[1:] = state[n - 1][:-1]
            context = np.zeros(len(word), np.int64)
            context[1:] = counts[n - 2][:-1]
            before[first] = 1 if n == 2 and starts else 0
            context[first] = starts if n == 2 else 0
            in_context = before > 0
            count = np.where(grams[n - 1][1], counts[n - 1], 0)
            p = np.where(in_context, (count + MASS * p) / (context + MASS), p)
            arcs = np.flatnonzero(in_context & (count > 0))
            keys, at = np.unique(before[arcs] * words + word[arcs], return_index=True)
            arc_keys.append(keys)
            weights.append(np.log10(p[arcs[at]]))
            targets.append(state[min(n, order - 1)][arcs[at]])
        # Contexts of different lengths are different states, so no key is there twice.
        every = np.concatenate([np.zeros(0, np.int64), *arc_keys])
        in_order = np.argsort(every)
        self._arcs = every[in_order]
        self._weights = np.concatenate([np.zeros(0), *weights])[in_order]
        self._targets = np.concatenate([np.zeros(0, np.int64), *targets])[in_order]
        self._fail, self._fail_to = np.array(fail), np.array(fail_to)
        self._next = np.zeros(words, np.int64)
        self._next[word] = state[1] if order > 1 else 0
        self._start = 1 if starts and order > 1 else 0
        longest = np.zeros(len(word), np.int64)
        for found in state[1:]:
            longest = np.where(found > 0, found, longest)
        self._before = np.empty(len(word), np.int64)
        self._before[1:] = longest[:-1]
        self._before[first] = self._start
        self._word, self._bounds = word, bounds

    def _follow(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The summed weights of what each state follows for its word, and the states after it."""
        state = state.copy()
        total, after = np.zeros(len(word)), np.zeros(len(word), np.int64)
        left = np.arange(len(word))
        while len(left):
            at_root = state[left] == 0
            done = left[at_root]
            total[done] += self._root[word[done]]
            after[done] = self._next[word[done]]
            left = left[~at_root]
            keys = state[left] * self._words + word[left]
            place = np.searchsorted(self._arcs, keys)
            found = np.zeros(len(left), bool)
            inside = place < len(self._arcs)
            found[inside] = self._arcs[place[inside]] == keys[inside]
            total[left[found]] += self._weights[place[found]]
            after[left[found]] = self._targets[place[found]]
            left = left[~found]
            total[left] += self._fail[state[left]]
            state[left] = self._fail_to[state[left]]
        return total, after

    def scores(self) -> np.ndarray:
        """The log10 probability of each of the texts that the automaton was made for."""
        total, _ = self._follow(self._before, self._word)
        return np.add.reduceat(total, self._bounds[:-1])

    def score(self, text: list[int]) -> float:
        """The same of any text of their words, token by token."""
        state, total = np.array([self._start]), 0.0
        for word in text:
            weight, state = self._follow(state, np.array([word]))
            total += float(weight[0])
        return total


def _fail(context: int) -> float:
    return log10(MASS / (context + MASS))


def _chunk_keys(table: pa.Table) -> tuple[np.ndarray, ...]:
    tokens, bounds = _tokens(table.column("text").combine_chunks())
    training = np.repeat(np.asarray(table.column("training")), np.diff(bounds))
    return tokens, bounds, training


def _asked(table: pa.Table, buckets: int, order: int) -> pa.Table:
    """A chunk's distinct n-grams and their training counts."""
    tokens, bounds, training = _chunk_keys(table)
    parts = [
        (n, *counting.counted(keys[there], training[there]))
        for n, (keys, there) in enumerate(_grams(tokens, bounds, order), 1)
    ]
    return counting.ask(table.column("chunk")[0].as_py(), buckets, parts)


def _scored(
    texts: pa.Table, counts: pa.Table, tokens_all: int, distinct_all: int, starts: int, order: int
) -> pa.Table:
    tokens, bounds, _ = _chunk_keys(texts)
    grams = _grams(tokens, bounds, order)
    words, word = np.unique(tokens, return_inverse=True)
    found = []
    for n, (keys, there) in enumerate(grams, 1):
        own = np.zeros(len(keys), np.int64)
        own[there] = counting.answered(counts, n)[np.unique(keys[there], return_inverse=True)[1]]
        found.append(own)
    floor = log10(tokens_all + distinct_all + 1)
    root = np.zeros(len(words))
    root[word] = np.log10(found[0] + 1.0) - floor
    machine = Automaton(word, bounds, root, grams, found, starts)
    out = {
        "n_tokens": np.diff(bounds),
        "n_known": np.add.reduceat((found[0] > 0).astype(np.int64), bounds[:-1]),
        "base_score": np.add.reduceat(root[word], bounds[:-1]),
        "score": machine.scores(),
    }
    kept = texts.drop_columns(["text", "chunk", "training"])
    for name, values in out.items():
        kept = kept.append_column(name, pa.array(values))
    return kept


def lm_scores(
    docs: DataFrame, training: Column, chunk: int = CHUNK, order: int = ORDER
) -> DataFrame:
    """``docs`` without ``text`` and with n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows where ``training`` holds, n-grams of up to ``order`` words. A null text is empty:
    its only token is the end. Scores are log10 probabilities; base_score is that of
    the add-one unigram model. Without training rows every token is unknown. All
    rows and other columns stay; columns of those names, in any case, are replaced.
    """
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "chunk", "training")
    text = F.coalesce("text", F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text) + 20), F.sum(training.cast("long"))).first()
    chunks = 1 + int(size[0] or 0) // chunk
    docs = docs.withColumn("training", F.coalesce(training, F.lit(False)))
    others = [c for c in docs.columns if c.lower() not in ("text", *added)]
    dealt = docs.select(
        *others,
        text.alias("text"),
        "training",
        F.pmod(F.xxhash64(*[c for c in others if c == "doc_id"], "text"), F.lit(chunks)).alias("chunk"),
    )
    starts = int(size[1] or 0)
    def unigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_groups(batch, "text", 4 * chunk):
                yield from _asked(pa.Table.from_batches([part]), chunks, 1).to_batches()

    found = counting.totals(dealt.mapInArrow(unigrams, counting.ASKED))
    totals = found.agg(F.sum("total"), F.sum("distinct")).first()
    tokens_all, distinct_all = int(totals[0] or 0), int(totals[1] or 0)
    # Grouped as below, so that the texts are dealt out once.
    back = counting.answers(
        dealt.groupBy("chunk").applyInArrow(lambda t: _asked(t, chunks, order), counting.ASKED)
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others]
    return (
        dealt.groupBy("chunk")
        .cogroup(back.groupBy("chunk"))
        .applyInArrow(
            lambda texts, own: _scored(texts, own, tokens_all, distinct_all, starts, order),
            ", ".join([*fields, "n_tokens long, n_known long, base_score double, score double"]),
        )
        .withColumn("train_tokens", F.lit(tokens_all).cast("long"))
    )
