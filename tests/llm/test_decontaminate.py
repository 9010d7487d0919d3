"""Decontamination against a brute-force search."""

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from footfall.llm import decontaminate
from footfall.plans.scratch import Scratch

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, h string, start string"
ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, window=10):
    out = []
    for doc_id, text, *_ in docs:
        w = words(text)
        hit, named = set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(window, len(v))
            for wanted in {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else ():
                for i in range(len(w) - n + 1):
                    if tuple(w[i : i + n]) == wanted:
                        hit.update(range(i, i + n))
                        named.add(item_id)
        named.discard(None)
        out.append((doc_id, len(w), len(hit), ",".join(sorted(map(str, named)))))
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    frame = decontaminate.contamination(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options
    )
    rows = frame.select("doc_id", "n_words", "n_hit", F.array_join("item_ids", ",")).collect()
    return sorted([tuple(r) for r in rows], key=str)


def passages(seed=5):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a", "und", "É", "x1"] + [f"w{i}" for i in range(25)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 9, 10, 11, 30]))) for i in range(12)]
    items += [(100, items[3][1].upper()), (101, None), (102, ""), (103, "..."), (None, say(12))]
    docs = []
    for i in range(60):
        parts = [say(rng.randrange(0, 25))]
        for _ in range(rng.randrange(0, 3)):
            text = rng.choice(items)[1] or ""
            parts += [rng.choice([text, text[: len(text) // 2], text + "!" + text]), say(3)]
        docs.append((i % 50, ", ".join(parts), "h", "s"))
    return docs + [(7, None, None, None), (None, items[6][1], "h", "s"), (8, "", "", "")], items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs, items = passages(seed)
    assert found(spark, docs, items) == brute(docs, items)


def test_long_text_repeats_and_copies(spark):
    item = " ".join(f"q{i}" for i in range(14))
    docs = [(1, (item + " ") * 300, "", ""), (2, item, "", ""), (2, item, "", ""), (3, item[3:], "", "")]
    assert found(spark, docs, [(5, item), (6, item)]) == brute(docs, [(5, item), (6, item)])


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b c")]) == []
    assert found(spark, [(1, "a b", "", "")], []) == [(1, 2, 0, "")]
    assert found(spark, [(1, "a b", "", "")], [(1, None)]) == [(1, 2, 0, "")]


def test_clean_keeps_columns_and_clean_rows(spark):
    item = " ".join(f"q{i}" for i in range(10))
    docs = [(1, "x " + item, "a", "b"), (2, "fine", "a", None), (None, None, "a", "b"), (2, "fine", "a", None)]
    frame = spark.createDataFrame(docs, DOCS)
    kept = decontaminate.clean(frame, spark.createDataFrame([(1, item)], ITEMS))
    assert kept.columns == frame.columns
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, docs[1:]))


@pytest.mark.parametrize("n, cells", [(0, 1 << 13), (8192, 1 << 13), (8193, 1 << 14), (10**6, 1 << 20), (10**9, 1 << 23)])
def test_table_grows_with_what_is_sought(n, cells):
    assert decontaminate.table_cells(n) == cells


@pytest.mark.parametrize("n", [500, 60_000])
def test_few_others_pass_the_table(spark, n):
    sought = spark.range(n).select(F.xxhash64("id").alias("token"))
    cells = decontaminate.table_cells(n)
    bits = decontaminate._bit_table(sought, cells).scalar().alias("bits")
    others = spark.range(n, n + 100_000).select(F.xxhash64("id").alias("token"), bits)
    assert others.where(decontaminate._in_table(F.col("token"), cells)).count() < 100_000 / 60
    own = sought.select("token", bits).where(decontaminate._in_table(F.col("token"), cells))
    assert own.count() == n


def test_tables_are_the_callers(spark):
    scratch = Scratch(spark, "own")
    frame = spark.createDataFrame([(1, "a b c", "", "")], DOCS)
    before = set(Path(spark.conf.get("spark.checkpoint.dir")).iterdir())
    decontaminate.contamination(frame, spark.createDataFrame([(1, "a b")], ITEMS), scratch=scratch).collect()
    assert set(Path(spark.conf.get("spark.checkpoint.dir")).iterdir()) - before == {Path(scratch.folder)}
    scratch.drop()
    assert set(Path(spark.conf.get("spark.checkpoint.dir")).iterdir()) == before


def test_plan_is_native(spark):
    docs, items = passages()
    frame = decontaminate.contamination(
        spark.createDataFrame(docs, DOCS).repartition(2), spark.createDataFrame(items, ITEMS)
    )
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"):
        assert node not in plan
