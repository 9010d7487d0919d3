"""Packing documents into training sequences as a cutting-stock problem.

A document gives full sequences and one rest that is shorter. How many rests there
are of each length is a small histogram, whatever the corpus. A linear program
picks patterns, multisets of lengths that fill a sequence, so that they use up the
histogram with the fewest sequences. Its patterns come from column generation: a
knapsack solved by dynamic programming finds the pattern that the current dual
prices make most worthwhile, until none helps. Patterns are used a whole number of
times, what that leaves over is filled greedily, and the rests of each length,
ranked, go to the places that patterns hold for them.

Only the histogram and the patterns pass through the driver: at most one number a
length class, and one row a pattern and class.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.llm.secret_scan import load_encoder
from footfall.llm.textbytes import mix, powers, row_groups, string_bytes

LENGTH = 1024
GRAIN = 8  # lengths in a class differ by less than this
_GAP = 1e-3  # the linear program may use this share of sequences more than it must
_TOGETHER = 1 << 20  # bytes of text that are encoded together
_ANY_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_WHITE = [c.encode() for c in map(chr, range(0x80, 0x3001)) if c.isspace()]
_SALTS = 32  # groups that the rests of one length are ranked in, at least
_RANKED = 50_000  # rests for which there is one more


class _Ids:
    """Token ids of whole texts, as little-endian 32-bit bytes.

    The vocabulary's splitting rule always begins a new piece before a space that
    something else than white space follows. So texts are cut there, and a piece
    that repeats among a megabyte of text is encoded once. Before that, texts are
    split at the strings of the vocabulary's added tokens, which have ids of their own.
    """

    def __init__(self, vocabulary: str | None, added: dict[bytes, int] | None = None) -> None:
        self._encoder = load_encoder(vocabulary)
        self._added = added_tokens(vocabulary) if added is None else added
        longest_first = sorted(self._added, key=len, reverse=True)
        self._any_added = re.compile(b"|".join(map(re.escape, longest_first)))
        self._size = np.zeros(self._encoder.n_vocab, np.int64)
        for value in self._encoder.token_byte_values():
            self._size[self._encoder.encode_single_token(value)] = len(value)

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self._encoder.encode_ordinary(text), np.uint32)

    def __call__(self, column: pa.Array) -> Iterator[bytes]:
        """For each row its ids; a null row has none."""
        data, offsets = string_bytes(column)
        for first, last in _row_ranges(offsets):
            if offsets[last] - offsets[first] <= 2 * _TOGETHER:
                yield from self._split_rows(data[offsets[first] : offsets[last]], offsets[first : last + 1])
            else:  # one long text, some of it at a time
                yield b"".join(
                    found
                    for at, stop in _slices(data, int(offsets[first]), int(offsets[last]))
                    for found in self._split_rows(data[at:stop], np.array([at, stop]))
                )

    def _split_rows(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        """``_rows`` of what is between added tokens, and the tokens' ids."""
        raw = data.tobytes()
        if not any(content in raw for content in self._added):
            yield from self._rows(data, offsets)
            return
        edges, known, lasts = [0], [], []
        for a, b in zip((offsets - offsets[0]).tolist(), (offsets[1:] - offsets[0]).tolist()):
            for m in self._any_added.finditer(raw, a, b):
                edges += m.span()
                known += [None, np.array([self._added[m.group()]], "<u4").tobytes()]
            edges.append(b)
            known.append(None)
            lasts.append(len(known))
        found = [own or ids for own, ids in zip(known, self._rows(data, np.array(edges)))]
        for a, b in zip([0, *lasts], lasts):
            yield b"".join(found[a:b])

    def _rows(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        offsets = offsets - offsets[0]
        begins = offsets[:-1][np.diff(offsets) > 0]
        cut = np.zeros(len(data), bool)
        cut[_piece_starts(data)] = True
        cut[begins] = True
        cuts = np.flatnonzero(cut)
        if not len(cuts):
            yield from [b""] * (len(offsets) - 1)
            return
        spans = np.diff(cuts, append=len(data))
        values = _ANY_BYTE[data]
        values *= powers(int(spans.max()))[np.arange(len(data)) - np.repeat(cuts, spans)]
        hashes = mix(np.add.reduceat(values, cuts))
        # A text's first piece may not follow another one, so it is encoded by itself.
        led = np.ones(len(cuts), bool)
        led[np.searchsorted(cuts, begins)] = False
        _, which, inverse = np.unique(hashes[led], return_index=True, return_inverse=True)
        starts, sizes = cuts[led][which], spans[led][which]
        raw = data.tobytes()
        together = b"".join([raw[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist())])
        ids = self._encode(together.decode())
        ends = np.searchsorted(np.cumsum(self._size[ids]), np.cumsum(sizes)) + 1
        alone = [
            self._encode(raw[a : a + n].decode())
            for a, n in zip(cuts[~led].tolist(), spans[~led].tolist())
        ]
        bounds = np.concatenate([[0], ends, ends[-1:] if len(ends) else [0]])
        alone_ends = np.cumsum([len(x) for x in alone], dtype=np.int64) + len(ids)
        from_, many = np.zeros(len(cuts), np.int64), np.zeros(len(cuts), np.int64)
        from_[led], many[led] = bounds[inverse], np.diff(bounds)[inverse]
        many[~led] = [len(x) for x in alone]
        from_[~led] = alone_ends - many[~led]
        ids = np.concatenate([ids, *alone])
        total = np.concatenate([[0], np.cumsum(many)])
        out = ids[np.arange(total[-1]) + np.repeat(from_ - total[:-1], many)]
        rows = total[np.searchsorted(cuts, offsets)].tolist()
        for a, b in zip(rows, rows[1:]):
            yield out[a:b].tobytes()


def added_tokens(vocabulary: str | None) -> dict[bytes, int]:
    """The strings with ids of their own that the public 50k vocabulary's tokenizer file lists.

    A rank file that a caller names has none.
    """
    if vocabulary is not None:
        return {}
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        listed = json.load(file)["added_tokens"]
    # Such as take in white space around them, or hold some, would need other cuts.
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]] for t in listed):
        raise ValueError("added tokens with white space or word bounds are not supported")
    return {t["content"].encode(): t["id"] for t in listed}


def _piece_starts(data: np.ndarray) -> np.ndarray:
    """Where a space is that no white space follows, nor the end."""
    spaces = np.flatnonzero(data == 0x20)
    padded = np.concatenate([data[spaces.min(initial=0) :], np.full(4, 0x20, np.uint8)])
    after = [padded[spaces - spaces.min(initial=0) + i] for i in (1, 2, 3)]
    white = (after[0] <= 0x20) | (after[0] == 0x7F)
    if (odd := after[0] >= 0x80).any():
        for lead in _WHITE:
            same = odd.copy()
            for part, byte in zip(after, lead):
                same &= part == byte
            white |= same
    return spaces[~white]


def _row_ranges(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows of about _TOGETHER bytes; a longer row comes alone."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + _TOGETHER, "right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def _slices(data: np.ndarray, at: int, end: int) -> Iterator[tuple[int, int]]:
    """Stretches of a long text that end where a piece does."""
    while at < end:
        stop = at + _TOGETHER
        while stop < end:
            found = _piece_starts(data[stop : min(stop + _TOGETHER, end)])
            if len(found):
                stop += int(found[0])
                break
            stop += _TOGETHER
        stop = min(stop, end)
        yield at, stop
        at = stop


def tokenised(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """For each document its id, number of ids and the checksums of its cuts of ``length``.

    A null text counts as empty. Every document ends with id 0. The strings of added
    tokens, such as an end of text, get the ids that the tokenizer gives them.
    """
    width = 4 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Ids(vocabulary)
        for batch in batches:
            sizes, sums = [], []
            for found in encode(batch.column("text")):
                ids = found + bytes(4)
                sizes.append(len(ids) // 4)
                sums.append([zlib.crc32(ids[i : i + width]) for i in range(0, len(ids), width)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.list_(pa.int64())),
                ],
                names=["doc_id", "doc_tokens", "cuts"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, doc_tokens long, cuts array<bigint>"
    )


def sequences(
    docs: DataFrame, pieces: DataFrame, vocabulary: str | None = None, length: int = LENGTH
) -> DataFrame:
    """(sequence_id, n_tokens, ids): what ``pack`` made of ``docs``, ready to train on.

    ``ids`` are little-endian unsigned 32-bit numbers, piece after piece. ``docs`` are the
    documents that were packed, with the same vocabulary and length; which of them a piece
    is of is told by id, size and checksum, and rows alike in those have the same ids there.
    """
    width = 4 * length
    own = ["doc_id", "start", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Ids(vocabulary)
        for batch in batches:
            for part in row_groups(batch, "text", _TOGETHER):
                rows, cuts, sizes = [], [], []
                for row, found in enumerate(encode(part.column("text"))):
                    ids = found + bytes(4)
                    for i in range(0, len(ids), width):
                        rows.append(row)
                        cuts.append((i // 4, ids[i : i + width]))
                        sizes.append(len(ids) // 4)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array([start for start, _ in cuts], pa.int64()),
                        pa.array([zlib.crc32(ids) for _, ids in cuts], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([ids for _, ids in cuts], pa.binary()),
                    ],
                    names=[*own, "ids"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    cuts = (
        docs.select("doc_id", "text")
        .mapInArrow(run, f"doc_id {kind}, start long, ids_crc32 long, doc_tokens long, ids binary")
        .dropDuplicates(own)
        .select(*[F.col(c).alias(f"_{c}") for c in own], "ids")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in own]
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    return pieces.join(cuts, same).groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), joined.alias("ids")
    )


# Patterns -------------------------------------------------------------------------


def _best_pattern(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, Counter]:
    """The unbounded knapsack: the most worthwhile pattern at these prices, by size in units."""
    by_size = np.zeros(room + 1)
    item = np.full(room + 1, -1)
    by_size[sizes] = prices
    item[sizes] = np.arange(len(sizes))
    value = np.zeros(room + 1)
    taken = np.zeros(room + 1, np.int64)  # size of the last item; 0: one unit is left empty
    for r in range(1, room + 1):
        options = by_size[1 : r + 1] + value[r - 1 :: -1]
        taken[r] = options.argmax() + 1
        value[r] = options[taken[r] - 1]
    pattern: Counter = Counter()
    r = room
    while r > 0:
        if item[taken[r]] >= 0 and by_size[taken[r]] > 0:
            pattern[int(item[taken[r]])] += 1
        r -= taken[r]
    return float(value[room]), pattern


def _whole(sizes: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[Counter, int]]:
    """Uses of patterns that hold every item exactly once.

    Solves the linear program by the revised simplex method over generated
    columns, rounds the uses down, and packs what is left by first-fit decreasing.
    """
    n = len(sizes)
    columns = [Counter({i: int(room // sizes[i])}) for i in range(n)]
    basis = list(range(n))
    inverse = np.diag([1.0 / (room // s) for s in sizes])
    uses = inverse @ demand
    for _ in range(40 * n + 100):
        prices = inverse.sum(axis=0)  # every sequence costs 1
        worth, pattern = _best_pattern(np.maximum(prices, 0), sizes, room)
        if worth <= 1 + _GAP:  # the optimum is at least the present value / worth
            break
        column = np.zeros(n)
        for i, many in pattern.items():
            column[i] = many
        direction = inverse @ column
        ratios = np.where(direction > 1e-9, uses / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(ratios.argmin())
        step = ratios[out]
        uses = np.maximum(uses - step * direction, 0)
        uses[out] = step
        basis[out] = len(columns)
        columns.append(pattern)
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
    left = demand.astype(np.int64).copy()
    plan = []
    for where in np.argsort(-uses, kind="stable"):
        pattern = columns[basis[where]]
        times = int(uses[where] + 1e-6)
        # Rounding errors never take more than there is.
        times = min([times, *(int(left[i]) // many for i, many in pattern.items())])
        if times > 0:
            plan.append((pattern, times))
            for i, many in pattern.items():
                left[i] -= many * times
    return plan + _first_fit(sizes, left, room)


def _first_fit(sizes: np.ndarray, left: np.ndarray, room: int) -> list[tuple[Counter, int]]:
    """Sequences filled one by one, each with the largest items that still fit."""
    out: Counter = Counter()
    order = np.argsort(-sizes)
    left = left.copy()
    while left.any():
        free, pattern = room, Counter()
        for i in order:
            many = min(int(left[i]), int(free // sizes[i]))
            if many:
                pattern[int(i)] += many
                free -= many * int(sizes[i])
        # The same sequence again as long as its items last.
        times = min(int(left[i]) // many for i, many in pattern.items())
        for i, many in pattern.items():
            left[i] -= many * times
        out[tuple(sorted(pattern.items()))] += times
    return [(Counter(dict(key)), times) for key, times in out.items()]


def patterns(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """How often to use which pattern: ({size: items of it}, uses).

    ``histogram`` gives the number of items of each size in units, all between 1
    and ``room``. The uses hold every item once.
    """
    sizes = np.array(sorted(s for s, n in histogram.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    demand = np.array([histogram[int(s)] for s in sizes], np.float64)
    return [
        ({int(sizes[i]): many for i, many in pattern.items()}, times)
        for pattern, times in _whole(sizes, demand, room)
    ]


# Places ---------------------------------------------------------------------------


def _places(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(size, first rank, items a use, first sequence, uses before all others of the size)."""
    rows, taken, sequence = [], Counter(), 0
    for pattern, times in plan:
        for size, many in pattern.items():
            rows.append((size, taken[size], taken[size] + many * times, many, sequence))
            taken[size] += many * times
        sequence += times
    return rows


def _ranked(rests: DataFrame, salts: int) -> DataFrame:
    """``rests`` with ``rank`` from 0 within each size, and ``before``: cuts of earlier rows.

    One size may hold a third of all rows, so each is dealt over ``salts`` groups;
    group totals, a table of sizes times salts rows, give each group its offset.
    """
    salted = rests.withColumn("salt", F.pmod(F.xxhash64("doc_id", "cuts"), F.lit(salts)))
    within = Window.partitionBy("size", "salt").orderBy("doc_id", "doc_tokens", "cuts")
    groups = salted.groupBy("size", "salt").agg(F.count(F.lit(1)).alias("rows"), F.sum("full").alias("fulls"))
    by_size = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sums = groups.groupBy("size").agg(F.sum("fulls").alias("size_fulls"))
    # Sizes are at most LENGTH many, so one task orders their totals.
    over = Window.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("size", F.coalesce(F.sum("size_fulls").over(over), F.lit(0)).alias("size_before"))
    offsets = groups.join(F.broadcast(sums), "size").select(
        "size",
        "salt",
        F.coalesce(F.sum("rows").over(by_size), F.lit(0)).alias("rank_before"),
        (F.col("size_before") + F.coalesce(F.sum("fulls").over(by_size), F.lit(0))).alias("full_before"),
    )
    so_far = within.rowsBetween(Window.unboundedPreceding, -1)
    return (
        salted.withColumn("own_rank", F.row_number().over(within) - 1)
        .withColumn("own_full", F.coalesce(F.sum("full").over(so_far), F.lit(0)))
        .join(offsets, ["size", "salt"])
        .select(
            "doc_id",
            "doc_tokens",
            "cuts",
            "size",
            "full",
            (F.col("own_rank") + F.col("rank_before")).alias("rank"),
            (F.col("own_full") + F.col("full_before")).alias("before"),
        )
    )


def _assigned(rows: DataFrame, places: list[tuple]) -> DataFrame:
    """``rows`` with ``sequence``, where the pattern holds a place for the row's rank."""
    by_size: dict[int, np.ndarray] = {}
    for size, *place in places:
        by_size.setdefault(size, []).append(place)
    table = {size: np.array(found, np.int64) for size, found in by_size.items()}
    bound = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("size").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence = np.full(len(size), -1, np.int64)
            for s in np.unique(size[size > 0]):
                own = np.flatnonzero(size == s)
                first, _, many, base = bound.value[int(s)].T
                at = np.searchsorted(first, rank[own], "right") - 1
                sequence[own] = base[at] + (rank[own] - first[at]) // many[at]
            yield batch.append_column("sequence", pa.array(sequence))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    return rows.mapInArrow(run, ", ".join([*fields, "sequence long"]))


def pack(pieces: DataFrame, length: int = LENGTH, grain: int = GRAIN) -> DataFrame:
    """Pieces of the documents that ``tokenised`` describes, placed in sequences.

    ``pieces`` (doc_id, doc_tokens, cuts) is read three times, so hand over a
    table rather than a plan that tokenises. Returns doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id and offset; an empty table gives no rows.
    Documents may share an id: rows alike in every column are interchangeable,
    and each gets pieces of its own. A null doc_id is kept.
    """
    rest = F.col("doc_tokens") % length
    rows = pieces.select(
        "doc_id",
        "doc_tokens",
        "cuts",
        F.ceil(rest / grain).cast("long").alias("size"),
        F.floor(F.col("doc_tokens") / length).cast("long").alias("full"),
    )
    counted = {
        r["size"]: (r["n"], r["fulls"])
        for r in rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("fulls")).collect()
    }
    total = sum(n for n, _ in counted.values())
    plan = patterns({s: n for s, (n, _) in counted.items() if s > 0}, length // grain)
    shared = sum(times for _, times in plan)
    salts = _SALTS + total // _RANKED
    placed = _assigned(_ranked(rows, salts), _places(plan))
    pieces = placed.select(
        "doc_id",
        "doc_tokens",
        "sequence",
        "before",
        "full",
        F.posexplode("cuts").alias("cut", "ids_crc32"),
    ).select(
        "doc_id",
        (F.col("cut") * F.lit(length).cast("long")).alias("start"),
        F.least(F.lit(length), F.col("doc_tokens") - F.col("cut") * F.lit(length)).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        F.when(F.col("cut") < F.col("full"), shared + F.col("before") + F.col("cut"))
        .otherwise(F.col("sequence"))
        .alias("sequence_id"),
        (F.col("cut") < F.col("full")).alias("whole"),
    )
    return _with_offsets(pieces, F.col("whole"))


def _with_offsets(pieces: DataFrame, whole: Column) -> DataFrame:
    """Offsets within sequences; only the pieces that share one need to meet."""
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    before = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("length"), "doc_id", "ids_crc32", "doc_tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shared = pieces.where(~whole).withColumn(
        "offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    )
    alone = pieces.where(whole).withColumn("offset", F.lit(0).cast("long"))
    return shared.select(columns).unionByName(alone.select(columns))
