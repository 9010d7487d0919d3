"""Near duplicates against a comparison of all pairs."""

import random
import re

import pyarrow as pa
import pytest

from footfall.llm import jaccard

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DDL = "doc_id long, text string, cls string, component_id string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs):
    sets = [shingles(text) for _, text, *_ in docs]
    part = list(range(len(docs)))

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                part[top(i)] = top(j)
    smallest = {}
    for i, (doc_id, *_) in enumerate(docs):
        if doc_id is not None:
            smallest[top(i)] = min(doc_id, smallest.get(top(i), doc_id))
    return sorted(((d[0], len(sets[i]), smallest.get(top(i))) for i, d in enumerate(docs)), key=str)


def found(spark, docs):
    frame = jaccard.near_duplicates(spark.createDataFrame(docs, DDL).repartition(3))
    assert frame.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, frame.collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    say = lambda n, v=4000: [f"w{rng.randrange(v)}" for _ in range(n)]
    passage, texts = say(60), []
    for _ in range(8):  # groups of copies with edits, some near the threshold
        origin = say(rng.choice([6, 30, 120]))
        for _ in range(rng.choice([1, 2, 9])):
            words = list(origin)
            for _ in range(rng.randrange(0, 1 + len(words) // 20)):
                words[rng.randrange(len(words))] = rng.choice(say(1))
            texts.append(words[: len(words) - rng.randrange(0, 1 + len(words) // 8)])
    chain = say(200)  # each is similar to the next, the ends are not
    texts += [chain[i * 9 : i * 9 + 100] for i in range(11)]
    for _ in range(25):  # a passage that many texts share
        texts.append(say(rng.randrange(5, 60)) + passage + say(rng.randrange(5, 60)))
    texts += [["few"], ["few", "words"], ["Few", "WORDS"], ["a"] * 300, ["a"] * 400, [], say(3, 5)]
    rng.shuffle(texts)
    return [(i, rng.choice([" ", "\n", " \t"]).join(t), "x", "y") for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, seed):
    docs = corpus(seed)
    assert found(spark, docs) == brute(docs)


def test_nulls_shared_ids_and_repeated_rows(spark):
    text = " ".join(f"v{i}" for i in range(50))
    docs = [(5, text, "", ""), (5, text, "", ""), (None, text + " end", "", ""), (5, "other text", "", "")]
    docs += [(4, None, None, None), (None, None, None, None), (6, "", "", ""), (7, " \n", "", ""), (None, "lone", "", "")]
    assert found(spark, docs) == brute(docs)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_large_group_of_near_copies(spark):
    """Every text differs from the origin in one word; no pair list is made of the group."""
    rng = random.Random(9)
    origin = [f"o{i}" for i in range(150)]
    docs = [(0, " ".join(origin), "", "")]
    for i in range(1, 600):
        words = list(origin)
        words[rng.randrange(150)] = f"edit{i}"
        docs.append((i, " ".join(words), "", ""))
    assert {r[2] for r in found(spark, docs)} == {0}


def test_one_of_each(spark):
    text = " ".join(f"v{i}" for i in range(50))
    docs = [(3, text, "a", "b"), (2, text + " x", "a", "b"), (9, "lone", "a", "b"), (9, "lone", "a", "b"), (None, None, "a", "b")]
    frame = spark.createDataFrame(docs, DDL)
    kept = jaccard.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([docs[1], docs[2], docs[4]], key=str)


def test_one_of_each_goes_by_row(spark):
    """Shared and null ids: a clean document stays, and one of each group."""
    near = lambda p: [" ".join(f"{p}{i}" for i in range(50)) + end for end in ("", " x", " y")]
    a, b, c = near("a"), near("b"), near("c")
    clean = [(5, "unique text of its own", "", ""), (3, "another clean one", "", ""), (None, "lone", "", "")]
    docs = [(3, a[0], "", ""), (5, a[1], "", "")]  # 3 stays, 5 is clean elsewhere
    docs += [(None, t, "", "") for t in b]  # all ids null
    docs += [(7, t, "", "") for t in c] + [(8, c[0], "", ""), (None, c[0], "", "")]  # the smallest id shared
    kept = [tuple(r) for r in jaccard.one_of_each(spark.createDataFrame(docs + clean, DDL).repartition(3)).collect()]
    assert set(clean) <= set(kept) and docs[0] in kept and len(kept) == len(clean) + 3
    assert sorted(r[0] or 0 for r in kept if r not in clean) == [0, 3, 7]
    frame = spark.createDataFrame([(*d, 1) for d in docs], DDL + ", row int")
    assert jaccard.one_of_each(frame).columns == frame.columns


@pytest.mark.parametrize("n", range(1, 60))
def test_need(n):
    """No smaller overlap reaches the threshold with any size of the other set."""
    need = jaccard._need(n, 80)
    assert all(100 * i < 80 * (n + m - i) for m in range(1, 200) for i in range(min(need, m + 1)))


def test_components_of_a_long_chain(spark):
    from footfall.plans.scratch import Scratch

    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    labels = jaccard.components(edges, Scratch(spark, "test"), "c")
    assert {(r.node, r.label) for r in labels.collect()} == {(i, 0) for i in range(201)} | {(500, 500), (501, 500)}


@pytest.mark.parametrize("n", range(1, 40))
def test_overlap(n):
    for m in range(1, 60):
        least = next(i for i in range(200) if 100 * i >= 80 * (n + m - i))
        assert jaccard._overlap(n, m, 80) == least


def test_prefixes_go_to_all_buckets_alike(spark):
    """Prefixes hold the smallest hashes; buckets are chosen by another number."""
    text = " ".join(f"w{i}" for i in range(20_000))
    table = pa.table({"chunk": [0] * 40, "text": [text[i * 100 : i * 100 + 90_000] for i in range(40)]})
    asked = jaccard._ask_prefixes(table, 16, 5, 80)
    sizes = [len(k.as_py()) for k in asked.column("keys")]
    assert asked.num_rows == 16 and max(sizes) < 2 * min(sizes)
