"""Substring removal against comparing all windows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from footfall.llm import substrings
from footfall.plans.scratch import Scratch

DDL = "doc_id long, text string, first string, Kept_Text string, edge string"
SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, span):
    windows = {}
    for i, t, *_ in rows:
        own = words(t)
        for p in range(len(own) - span + 1):
            if i is not None:
                key = tuple(own[p : p + span])
                windows[key] = min(windows.get(key, i), i)
    out = []
    for i, t, *_ in rows:
        own, gone = words(t), set()
        for p in range(len(own) - span + 1):
            if i is not None and windows[tuple(own[p : p + span])] < i:
                gone.update(range(p, p + span))
        out.append((i, len(own), len(gone), " ".join(w for n, w in enumerate(own) if n not in gone)))
    return sorted(out, key=str)


def found(spark, rows, span, size):
    frame = spark.createDataFrame(rows, DDL).repartition(4)
    out = substrings.without_repeats(frame, Scratch(spark, "test"), span, size)
    assert out.columns == ["doc_id", "text", "first", "edge", "n_words", "n_removed", "kept_text"]
    picked = out.select("doc_id", "n_words", "n_removed", "kept_text")
    return sorted(map(tuple, picked.collect()), key=str)


def row(i, text):
    return (i, text, "f", "k", "e")


def made(seed, n, vocabulary, span):
    """Texts that share passages, some exact copies, some changed in a word."""
    rng = random.Random(seed)
    some = [f"{rng.choice('aAbé')}{j}" for j in range(vocabulary)]
    passages = [[rng.choice(some) for _ in range(rng.randrange(1, 4 * span))] for _ in range(6)]
    rows = []
    for i in range(n):
        own = []
        for _ in range(rng.randrange(5)):
            own += rng.choice(passages) if rng.random() < 0.7 else rng.choices(some, k=rng.randrange(9))
            if own and rng.random() < 0.3:
                own[rng.randrange(len(own))] = "X"
        rows.append(row(rng.randrange(10 * n), "".join(w + rng.choice(SPACE) for w in own)))
    return rows


@pytest.mark.parametrize("seed, vocabulary, span, size", [(1, 400, 9, 3), (2, 2, 6, 2), (3, 30, 5, 5), (4, 9, 4, 1)])
def test_against_all_windows(spark, monkeypatch, seed, vocabulary, span, size):
    monkeypatch.setattr(substrings, "_BLOCK", 13)
    monkeypatch.setattr(substrings, "_GROUP", 300)
    rows = made(seed, 90, vocabulary, span)
    long = " ".join(f"w{j % 40}" for j in range(200))  # repeats itself, longer than a block
    rows += [row(5000, long), row(4000, "z " + long), row(5001, long.upper())]
    rows += [rows[0], rows[0], row(rows[1][0], rows[2][1]), row(None, long), row(None, None)]
    rows += [row(6000, None), row(6001, ""), row(6002, " \n"), (6003, long, None, None, None)]
    assert found(spark, rows, span, size) == brute(rows, span)


def test_blocks_do_not_change_the_result(spark):
    rows = [row(i, " ".join(f"w{j}" for j in range(i, i + 120))) for i in range(30)]
    assert found(spark, rows, 50, 12) == brute(rows, 50)


def test_no_rows_and_short_texts(spark):
    assert found(spark, [], 50, 12) == []
    rows = [row(1, "a b c"), row(2, "a b c")]
    assert found(spark, rows, 50, 12) == brute(rows, 50)


def test_one_word_without_spaces_and_a_very_long_text(spark):
    long = "".join(f"{j} " for j in range(400_000))
    rows = [row(1, "日" * 1_000_000), row(2, "日" * 1_000_000), row(3, long), row(4, "x " + long)]
    got = found(spark, rows, 50, 12)
    assert [(i, n, gone) for i, n, gone, _ in got] == [
        (1, 1, 0), (2, 1, 0), (3, 400_000, 0), (4, 400_001, 400_000)
    ]


def test_copies_are_one_row_a_path(spark):
    """However many copies there are, a path is checked once, and never pair by pair."""
    text = " ".join(f"w{j}" for j in range(300))
    rows = [row(i, text) for i in range(200)] + [row(500, "y " + text + " y")]
    scratch = Scratch(spark, "test")
    frame = spark.createDataFrame(rows, DDL).repartition(4)
    gone = substrings.repeats(frame, scratch, 50, 12)
    assert gone.select("doc_id").distinct().count() == 200
    windows = spark.read.parquet(f"{scratch.folder}/windows")
    assert windows.where(F.col("doc_id") > 0).count() <= 4 * 39
    assert windows.count() <= 8 * 39
