"""Cheapest repair of a conversation's structure, by a run-length dynamic program.

A repaired conversation is empty, or an optional system row and then user and assistant
rows in turn: role initials ``(s?(ua)+)?``. Rows may be kept, given another role, deleted
or preceded by inserted ones, at the costs below. A row matters only by its symbol: its
role's initial and its fault. A symbol is a min-plus matrix over the four states of that
pattern, and a run of equal symbols is a power of it, put together from cached powers of
two. From the end of a conversation back, matrices give the cost of the best rest in every
state; going forward again, each row takes the first letter that such a rest allows.

Nothing but symbols is needed for this, so they travel without their texts, and equal
rows are counted before they do. Sorted by conversation and turn, symbols are cut into
fragments, a long conversation into many; each fragment's matrix is computed where it
lies, and only fragments meet per conversation. The texts are shuffled once, by
conversation, for the repaired rows and their digest. A digest is one chain over a whole
conversation, so one task streams through the longest one, in constant memory but for
the audit.

Rows of a conversation stand by turn, nulls first. Rows with the same turn stand by the
md5 of role and text; equal rows are told apart by nothing. A null role or text is one
space. Rows with a null ``conv_id`` are one conversation. Only the four named columns are
read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from footfall.llm.textbytes import row_groups

RE_ROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1  # costs; keeping is free
FAULTS = ("", "blank", "duplicate", "truncated")
_INITIALS = "sua"  # any other initial is number 3
# States: nothing yet, after a system row, after a user row, after an assistant row.
_STATES = range(4)
_NEXT = ((1, 2, None), (None, 2, None), (None, None, 3), (None, 2, None))
_ADDED = (1, 1, 2, 1)  # the initial that an inserted or changed row gets in each state
_ROLES = ("system", "user", "assistant")
_NEVER = 1 << 60
_STEP = 4096  # rows of a run that are unrolled together
_GROUP = 1 << 20  # bytes of text looked at together
_MOST = (1 << 63) - 1

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _remembered(most: int) -> Callable[[Callable], Callable]:
    """Keeps up to ``most`` results of a function; unlike those of functools, it travels to tasks."""

    def wrap(function: Callable) -> Callable:
        known: dict[tuple, object] = {}

        def call(*arguments):
            if arguments not in known:
                if len(known) >= most:
                    known.clear()
                known[arguments] = function(*arguments)
            return known[arguments]

        return call

    return wrap


def _plus(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    return tuple(
        tuple(min(min(x + row[j] for x, row in zip(own, b)), _NEVER) for j in _STATES) for own in a
    )


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(min(x + y for x, y in zip(own, v)), _NEVER) for own in a)


def _insertions() -> Matrix:
    """The cost of getting from state to state by inserted rows alone."""
    out = [[0 if i == j else _NEVER for j in _STATES] for i in _STATES]
    for state in _STATES:
        at, cost = state, 0
        for _ in _STATES:
            at, cost = _NEXT[at][_ADDED[at]], cost + INSERT
            out[state][at] = min(out[state][at], cost)
    return tuple(map(tuple, out))


_INSERTED = _insertions()
#: What the end of a conversation costs in each state: no row, or whole pairs.
END: Vector = _apply(_INSERTED, (0, _NEVER, _NEVER, 0))


def _moves(sym: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may become of a row, by letter."""
    initial, fault = divmod(sym, 4)
    moves = [("D", DELETE, state)]
    if FAULTS[fault] in ("blank", "duplicate"):
        return moves
    extra = TRUNCATED if FAULTS[fault] == "truncated" else 0
    if initial < 3 and _NEXT[state][initial] is not None:
        moves.append(("K", extra, _NEXT[state][initial]))
    moves.append(("R", RE_ROLE + extra, _NEXT[state][_ADDED[state]]))
    return moves


@_remembered(16 * 64)  # 16 symbols with some 60 powers each at most
def power(sym: int, log: int) -> Matrix:
    """The matrix of 2**log rows with this symbol, insertions before each included."""
    if log:
        return _plus(power(sym, log - 1), power(sym, log - 1))
    row = [[_NEVER] * 4 for _ in _STATES]
    for state in _STATES:
        for _, cost, after in _moves(sym, state):
            row[state][after] = min(row[state][after], cost)
    return _plus(_INSERTED, tuple(map(tuple, row)))


def before_run(sym: int, length: int, after: Vector) -> Vector:
    """The costs of the best rest before a run, given those after it."""
    for log in range(length.bit_length()):
        if length >> log & 1:
            after = _apply(power(sym, log), after)
    return after


_IDENTITY: Matrix = tuple(tuple(0 if i == j else _NEVER for j in _STATES) for i in _STATES)


@_remembered(1 << 14)
def matrix(runs: tuple[tuple[int, int], ...]) -> Matrix:
    """The matrix of some runs of (symbol, length)."""
    # Column by column: how the best rest depends on where the runs leave.
    columns = []
    for unit in _IDENTITY:
        for sym, length in reversed(runs):
            unit = before_run(sym, length, unit)
        columns.append(unit)
    return tuple(zip(*columns))


@_remembered(1 << 16)
def _choice(sym: int, state: int, after: Vector) -> tuple[str, int]:
    """The letters before and of a row, and the state after it."""
    rest = _apply(power(sym, 0), after)
    letters = ""
    while True:
        options = _moves(sym, state)
        added = _NEXT[state][_ADDED[state]]
        for letter, cost, to in [options[0], ("I", INSERT, added), *options[1:]]:
            if cost + (rest if letter == "I" else after)[to] == rest[state]:
                break
        letters, state = letters + letter, to
        if letter != "I":
            return letters, state


def _relative(v: Vector) -> Vector:
    """Costs less the least one: only differences decide, and few vectors differ in them."""
    least = min(v)
    return tuple(min(x - least, _NEVER) for x in v)


@_remembered(1 << 16)
def _back(sym: int, after: Vector) -> Vector:
    return _relative(_apply(power(sym, 0), after))


def unrolled(runs: list[tuple[int, int]], after: Vector, state: int) -> Iterator[str]:
    """The letters of each row: insertions, then what becomes of the row."""
    ends = [after]
    for sym, length in reversed(runs):
        ends.append(before_run(sym, length, ends[-1]))
    for (sym, length), end in zip(runs, ends[-2::-1]):
        for done in range(0, length, _STEP):
            some = min(_STEP, length - done)
            rest = _relative(before_run(sym, length - done - some, end))
            rests = [rest]
            for _ in range(some - 1):
                rest = _back(sym, rest)
                rests.append(rest)
            for rest in reversed(rests):
                letters, state = _choice(sym, state, rest)
                yield letters


# Symbols of rows


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    number = F.lit(len(_INITIALS))
    for at, letter in enumerate(_INITIALS):
        number = F.when(first == letter, at).otherwise(number)
    return number


def _own_fault(text: Column) -> Column:
    """The number of a row's fault, as far as the row alone tells."""
    last = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", FAULTS.index("blank")).when(last.isin(".", "!", "?"), 0)
    return fault.otherwise(FAULTS.index("truncated"))


def _prepared(rows: DataFrame) -> DataFrame:
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    own = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    told = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return own.withColumn("digest", F.unhex(F.md5(told)))


def _symbols(prepared: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, n, initial, fault, is_first) of each set of equal rows.

    ``is_first``: no equal role and text stands in an earlier turn.
    """
    counted = prepared.groupBy("conv_id", "turn", "digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(_initial(F.col("role"))).alias("initial"),
        F.min(_own_fault(F.col("text"))).alias("fault"),
    )
    # A null turn comes first in a struct's order, too.
    firsts = counted.groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest")).agg(
        F.min(F.struct("turn")).alias("_first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))
    is_first = F.col("turn").eqNullSafe(F.col("_first.turn"))
    return counted.join(firsts, same).select(*counted.columns, is_first.alias("is_first"))


def _runs(initial: np.ndarray, fault: np.ndarray, is_first: np.ndarray, n: np.ndarray):
    """(symbols, lengths) of sorted sets of equal rows, equal neighbours collapsed."""
    blank, duplicate = FAULTS.index("blank"), FAULTS.index("duplicate")
    later = np.where(fault == blank, blank, duplicate)
    first = np.where(is_first, fault, later)
    syms = (np.stack([initial, initial], 1) * 4 + np.stack([first, later], 1)).ravel()
    lengths = np.stack([np.ones_like(n), n - 1], 1).ravel()
    syms, lengths = syms[lengths > 0], lengths[lengths > 0]
    new = np.concatenate([[0], np.flatnonzero(np.diff(syms)) + 1])
    return syms[new], np.add.reduceat(lengths, new)


_FRAGMENT = "turn long, digest binary, symbols array<int>, lengths array<long>"


def _fragments(symbols: DataFrame) -> DataFrame:
    """(conv_id, turn, digest of the first row, symbols, lengths, costs) of pieces in order.

    ``costs`` are the entries of the piece's matrix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id")
            changes = pa.compute.run_end_encode(conv).run_ends.to_numpy()
            initial, fault, n = (
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in ("initial", "fault", "n")
            )
            is_first = batch.column("is_first").to_numpy(zero_copy_only=False)
            begins = np.concatenate([[0], changes[:-1]]).astype(np.int64)
            pieces, costs = [], []
            for a, b in zip(begins.tolist(), changes.tolist()):
                syms, lengths = _runs(initial[a:b], fault[a:b], is_first[a:b], n[a:b])
                pieces.append((syms.tolist(), lengths.tolist()))
                own = matrix(tuple(zip(*pieces[-1])))
                costs.append([cost for row in own for cost in row])
            at = pa.array(begins)
            yield pa.RecordBatch.from_arrays(
                [
                    conv.take(at),
                    batch.column("turn").take(at),
                    batch.column("digest").take(at),
                    pa.array([s for s, _ in pieces], pa.list_(pa.int32())),
                    pa.array([l for _, l in pieces], pa.list_(pa.int64())),
                    pa.array(costs, pa.list_(pa.int64())),
                ],
                names=["conv_id", "turn", "digest", "symbols", "lengths", "costs"],
            )

    order = ["conv_id", F.asc_nulls_first("turn"), "digest"]
    id_type = symbols.schema["conv_id"].dataType.simpleString()
    ordered = symbols.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, f"conv_id {id_type}, {_FRAGMENT}, costs array<long>")


_NO_CONVERSATION = object()


def _with_rest(fragments: DataFrame) -> DataFrame:
    """Fragments with ``rest``: what follows each costs at best in every state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rest = _NO_CONVERSATION, END
        for batch in batches:
            rests = []
            for conv, costs in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "costs"))):
                if conv != last:
                    last, rest = conv, END
                rests.append(rest)
                rest = _apply(tuple(tuple(costs[i : i + 4]) for i in range(0, 16, 4)), rest)
            names = ["conv_id", "turn", "digest", "symbols", "lengths"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(rests, pa.list_(pa.int64()))],
                names=[*names, "rest"],
            )

    id_type = fragments.schema["conv_id"].dataType.simpleString()
    back = ["conv_id", F.desc_nulls_last("turn"), F.desc("digest")]
    ordered = fragments.repartition("conv_id").sortWithinPartitions(*back)
    return ordered.mapInArrow(run, f"conv_id {id_type}, {_FRAGMENT}, rest array<long>")


def _streamed(rows: DataFrame) -> DataFrame:
    """Rows by conversation in order, each fragment before its rows."""
    prepared = _prepared(rows)
    fragments = _with_rest(_fragments(_symbols(prepared)))
    none = F.lit(None)
    texts = prepared.select(
        "*",
        none.cast("array<int>").alias("symbols"),
        none.cast("array<long>").alias("lengths"),
        none.cast("array<long>").alias("rest"),
        F.lit(1).alias("kind"),
    )
    heads = fragments.withColumns(
        {"role": none.cast("string"), "text": none.cast("string"), "kind": F.lit(0)}
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "digest", "kind"]
    return texts.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order)


class _Conversation:
    """What is known of a conversation so far."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.state = 0
        self.letters: Iterator[str] = iter(())
        self.audit = io.StringIO()
        self.place = 0  # of the next repaired row
        self.faults = [0, 0, 0, 0]
        self.illegal = 0
        self.cost: int | None = None
        self.least = self.most = self.last_initial = None
        self.turns = 0
        self._digest = hashlib.sha256()

    def begin(self, symbols: list[int], lengths: list[int], rest: list[int]) -> None:
        """A fragment: its rows follow."""
        runs = list(zip(symbols, lengths))
        for sym, length in runs:
            initial, fault = divmod(sym, 4)
            self.faults[fault] += length
            pairs = [(self.last_initial, initial, 1), (initial, initial, length - 1)]
            for a, b, n in pairs:
                if a is not None and (a, b) not in ((0, 1), (1, 2), (2, 1)):
                    self.illegal += n
            self.last_initial = initial
        if self.cost is None:
            before = tuple(rest)
            for sym, length in reversed(runs):
                before = before_run(sym, length, before)
            self.cost = before[0]
        self.letters = unrolled(runs, tuple(rest), self.state)

    def row(self, turn: int | None, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The (letter, role, text) that stand for a row after the repair."""
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn
        letters = next(self.letters)
        self.audit.write(letters)
        for letter in letters:
            if letter == "D":
                continue
            to = _INITIALS.index(role[0]) if letter == "K" else _ADDED[self.state]
            yield letter, role if letter == "K" else _ROLES[to], "" if letter == "I" else text
            self.state = _NEXT[self.state][to]

    def end(self) -> Iterator[tuple[str, str, str]]:
        """Rows inserted after the last one."""
        while self.state in (1, 2):
            self.audit.write("I")
            to = _ADDED[self.state]
            yield "I", _ROLES[to], ""
            self.state = _NEXT[self.state][to]

    def line(self, role: str, text: str) -> None:
        """Adds a repaired row to the digest."""
        self._digest.update(("\n" if self.place else "").encode() + f"{role}:{text}".encode())
        self.place += 1

    def summary(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        blank, duplicate, truncated = self.faults[1:]
        numbers = (min(gaps, _MOST), blank, duplicate, truncated, self.illegal, self.cost)
        return (self.conv_id, *numbers, self.audit.getvalue(), self._digest.hexdigest())


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """For some rows at a time: ("row", conversation, letter, role, text), ("end", conversation)."""
    own: _Conversation | None = None
    names = ("conv_id", "turn", "role", "text", "symbols", "lengths", "rest", "kind")
    for batch in batches:
        for part in row_groups(batch, "text", _GROUP):
            out: list[tuple] = []
            for conv_id, turn, role, text, symbols, lengths, rest, kind in zip(
                *(part.column(c).to_pylist() for c in names)
            ):
                if own is None or own.conv_id != conv_id:
                    if own is not None:
                        out += [("row", own, *r) for r in own.end()]
                        out.append(("end", own))
                    own = _Conversation(conv_id)
                if kind == 0:
                    own.begin(symbols, lengths, rest)
                else:
                    out += [("row", own, *r) for r in own.row(turn, role, text)]
            yield out
    if own is not None:
        yield [*(("row", own, *r) for r in own.end()), ("end", own)]


def repairs(rows: DataFrame) -> DataFrame:
    """One row for each conversation with rows: what was wrong and what its repair costs.

    ``gaps`` are missing turns (nulls ignored, all null: 0), ``blank``, ``duplicate`` and
    ``truncated`` count rows by their first fault, ``illegal`` adjacent rows whose role
    initials are not su, ua or au. ``cost`` is the least cost of a repair and ``audit`` the
    letters of its edits in order, the least such text: Keep, Rerole, Delete, Insert.
    ``repaired_sha256`` is over the repaired rows as ``role:text``, joined by newlines.
    """
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kinds = [pa.int64()] * len(columns) + [pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for events in _walked(batches):
            ended = []
            for event in events:
                if event[0] == "end":
                    ended.append(event[1].summary())
                else:
                    event[1].line(*event[3:])
            if ended:
                ids, *rest = zip(*ended)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, id_kind), *(pa.array(c, k) for c, k in zip(rest, kinds))],
                    names=["conv_id", *columns, "audit", "repaired_sha256"],
                )

    id_kind = pa.string() if _id_name(rows) == "string" else pa.int64()
    longs = ", ".join(f"{c} long" for c in columns)
    return _streamed(_id_known(rows)).mapInArrow(
        run, f"conv_id {_id_name(rows)}, {longs}, audit string, repaired_sha256 string"
    )


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the repaired conversations' rows, from place 0 on.

    ``edit`` is K, R or I for kept rows, such with another role, and inserted ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for events in _walked(batches):
            out = []
            for event in events:
                if event[0] == "row":
                    own = event[1]
                    out.append((own.conv_id, own.place, *event[2:]))
                    own.place += 1
            if out:
                kinds = (id_kind, pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    names=["conv_id", "place", "edit", "role", "text"],
                )

    id_kind = pa.string() if _id_name(rows) == "string" else pa.int64()
    return _streamed(_id_known(rows)).mapInArrow(
        run, f"conv_id {_id_name(rows)}, place long, edit string, role string, text string"
    )


def _id_name(rows: DataFrame) -> str:
    """Whole numbers are longs in what comes out, other ids text."""
    return "bigint" if isinstance(rows.schema["conv_id"].dataType, IntegralType) else "string"


def _id_known(rows: DataFrame) -> DataFrame:
    return rows.withColumn("conv_id", F.col("conv_id").cast(_id_name(rows)))
