"""Conversation repair against trying all edits."""

import hashlib
import os
import random
import re
import subprocess
import sys
from functools import lru_cache

import pytest
from pyspark import cloudpickle

from footfall.llm import conversations as conv

DDL = "conv_id long, turn long, role string, text string, digest string, Cost string"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
FULL = {"u": "user", "a": "assistant"}


def judged(rows):
    """(role, text, first fault) of a conversation's rows in order."""
    def order(row):
        told = f"{len(row[1])}:{row[1]}{row[2]}"
        return (row[0] is not None, row[0] or 0, hashlib.md5(told.encode()).hexdigest())

    seen, out = set(), []
    for turn, role, text in sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=order):
        visible = VISIBLE.findall(text)
        if not visible:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "" if visible[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(rows):
    own = judged(rows)

    @lru_cache(maxsize=None)
    def best(i, last, inserted):
        """(cost, audit, lines) of the cheapest rest, by trying everything."""
        options = []
        if i == len(own):
            if last in ("", "a"):
                options.append((0, "", ()))
        else:
            role, text, fault = own[i]
            rest = best(i + 1, last, 0)
            options.append((rest[0] + 3, "D" + rest[1], rest[2]))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if (last, role[:1]) in AFTER:
                    rest = best(i + 1, role[0], 0)
                    options.append((rest[0] + extra, "K" + rest[1], (f"{role}:{text}", *rest[2])))
                for to in "ua":
                    if (last, to) in AFTER:
                        rest = best(i + 1, to, 0)
                        options.append((rest[0] + 2 + extra, "R" + rest[1], (f"{FULL[to]}:{text}", *rest[2])))
        if inserted < 3:
            for to in "ua":
                if (last, to) in AFTER:
                    rest = best(i, to, inserted + 1)
                    options.append((rest[0] + 2, "I" + rest[1], (f"{FULL[to]}:", *rest[2])))
        return min(options, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    turns = [t for t, *_ in rows if t is not None]
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(own, own[1:])]
    counts = [sum(f == fault for *_, f in own) for fault in ("blank", "duplicate", "truncated")]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest), lines


def frame(spark, conversations):
    rows = [(c, t, r, x, "d", "c") for c, rows in conversations.items() for t, r, x in rows]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, DDL).repartition(3)


def check(spark, conversations):
    rows = frame(spark, conversations)
    got = {r[0]: tuple(r[1:]) for r in conv.repairs(rows).collect()}
    lines = {c: [] for c in conversations}
    for r in sorted(conv.repaired(rows).collect(), key=lambda r: r.place):
        assert r.place == len(lines[r.conv_id]) and r.edit in "KRI"
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    for c, own in conversations.items():
        expected, expected_lines = brute(own)
        assert got[c] == expected, (c, own)
        assert lines[c] == list(expected_lines)
    assert len(got) == len(conversations)


def made(rng, length):
    roles = ["system", "user", "assistant", "tool", "", "u", None, "ΩΣ"]
    texts = ["Yes.", "No!", "cut", "é?  \n", "", " \t", None, "A\nB.", "x" * 9, ".", "日本"]
    return [
        (rng.choice([None, *range(-2, 2 * length)]), rng.choices(roles, [3, 9, 9, 1, 1, 1, 1, 1])[0], rng.choice(texts))
        for _ in range(length)
    ]


def test_against_all_edits(spark):
    rng = random.Random(3)
    own = {i: made(rng, rng.randrange(1, 9)) for i in range(300)}
    own[None] = made(rng, 6)
    own[-1] = [(1, "user", "Hi.")] * 5  # rows alike in all columns
    check(spark, own)


def test_a_long_conversation_in_many_fragments(spark):
    rng = random.Random(5)
    long = [(i, rng.choice(["user", "assistant"]), f"t{rng.randrange(200)}.") for i in range(400)]
    runs = [(i, "user", f"{i}.") for i in range(150)] + [(200 + i, "assistant", f"{i}") for i in range(90)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        check(spark, {1: long, 2: runs, 3: [(0, "system", "S.")], 4: [(5, "user", "U.")] * 120})
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nulls_everywhere_and_no_rows(spark):
    check(spark, {None: [(None, None, None)], 7: [(None, "user", "a."), (None, "assistant", "b.")]})
    empty = spark.createDataFrame([], DDL)
    assert conv.repairs(empty).count() == 0 and conv.repaired(empty).count() == 0


def test_a_very_long_text_and_text_ids(spark):
    rows = [("a", 1, "user", "x " * 1_000_000 + "."), ("a", 2, "assistant", "y.")]
    got = conv.repairs(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).first()
    assert got[:8] == ("a", 0, 0, 0, 0, 0, 0, "KK")


@pytest.mark.parametrize("length", [1, 2, 3, 64, 1000, 4097])
def test_runs_by_powers_equal_single_rows(length):
    for sym in range(16):
        one_by_one = conv.END
        for _ in range(length):
            one_by_one = conv.before_run(sym, 1, one_by_one)
        assert conv.before_run(sym, length, conv.END) == one_by_one
        assert conv.matrix(((sym, length),)) == conv.matrix(((sym, 1),) * length) or length > 64
        letters = list(conv.unrolled([(sym, length)], conv.END, 0))
        assert len(letters) == length


def test_executors_need_no_package_of_ours(tmp_path):
    """What a task runs is pickled with all it calls, caches included."""
    conv.before_run(1, 9, conv.END)
    path = tmp_path / "task"
    path.write_bytes(cloudpickle.dumps((conv.unrolled, conv.matrix, conv.END)))
    code = (
        "import sys, pickle\n"
        "unrolled, matrix, end = pickle.load(open(sys.argv[1], 'rb'))\n"
        "assert 'footfall' not in sys.modules and len(matrix(((4, 3),))) == 4\n"
        "print(''.join(unrolled([(4, 1), (8, 1)], end, 0)))"
    )
    ran = subprocess.run([sys.executable, "-c", code, str(path)], cwd=tmp_path, env={"PATH": os.environ["PATH"]}, capture_output=True, text=True)
    assert ran.stdout.strip() == "KK", ran.stderr
