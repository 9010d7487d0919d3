"""Hashes of words, whatever the pieces that texts are looked at in."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import textbytes
from footfall.llm.textbytes import word_hashes

SPACE = " \t\n\x0b\x0c\r"


def made(seed):
    rng = random.Random(seed)
    texts = [None, "", " ", "x" * 700, "y " + "é" * 500 + " z", "A" * 90 + "  b"]
    for _ in range(60):
        words = ["".join(rng.choices("abAé日", k=rng.choice([1, 2, 5, 40, 300]))) for _ in range(rng.randrange(9))]
        texts.append("".join(w + rng.choice(SPACE) * rng.randrange(1, 3) for w in words)[rng.randrange(2) :])
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("fold", [True, False])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_words_have_equal_hashes(monkeypatch, seed, fold):
    column = pa.array(made(seed))
    whole, bounds = word_hashes(column, fold)
    numbers = {}
    for text, a, b in zip(column.to_pylist(), bounds, bounds[1:]):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        if fold:
            words = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
        assert len(words) == b - a
        for word, number in zip(words, whole[a:b].tolist()):
            assert numbers.setdefault(word, number) == number
    assert len(set(numbers.values())) == len(numbers)
    for piece in (1, 3, 16, 100, 1000):
        monkeypatch.setattr(textbytes, "PIECE", piece)
        monkeypatch.setattr(textbytes, "_POWERS", [np.ones(1, np.uint64)])
        again, edges = word_hashes(column, fold)
        assert (again == whole).all() and (edges == bounds).all()


def test_a_word_of_many_megabytes_takes_little_memory():
    column = pa.array(["a " + "日" * 5_000_000 + " b"])
    tracemalloc.start()
    hashes, bounds = word_hashes(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert bounds.tolist() == [0, 3] and len(set(hashes.tolist())) == 3
    assert peak < 40e6
