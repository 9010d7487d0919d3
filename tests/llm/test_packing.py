"""Packing: exact ids, every id once, full sequences."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

ODD = [
    "", "a  b", "a \n b", "x\n \ny ", " lead", " ", "\n", "a b ", "tab\t x", "é à  ", "<|endoftext|> a",
    "hello <|endoftext|> world", "<|endoftext|><|endoftext|>", "x<|endoftext|>y <|endof", "text|> <|endoftext", "|>",
    "I'm we'll  it's  x 　y", None, "z \x1c \x85 a   ", "日本 語  ", "a\xa0 b \xa0c", "😀 😀😀",
]


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("together", [8, 300, 1 << 22])
def test_ids_are_the_tokenizers(spark, tokenizer, monkeypatch, together):
    monkeypatch.setattr(packing, "_TOGETHER", together)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = ODD + [r.text[:3000] for r in table.limit(60).collect()]
    found = list(packing._Ids(None)(pa.array(texts, pa.string())))
    for text, raw in zip(texts, found, strict=True):
        assert np.frombuffer(raw, np.uint32).tolist() == ids_of(tokenizer, text), text


def check_pieces(rows, docs, tokenizer):
    ids = [[*ids_of(tokenizer, text), 0] for _, text in docs]
    wanted = sorted((doc_id is None, doc_id or 0, len(x)) for (doc_id, _), x in zip(docs, ids))
    firsts = sorted((r.doc_id is None, r.doc_id or 0, r.doc_tokens) for r in rows if r.start == 0)
    assert firsts == wanted
    crc = defaultdict(int)
    for (doc_id, _), own in zip(docs, ids):
        for at in range(0, len(own), 1024):
            part = np.array(own[at : at + 1024], "<u4").tobytes()
            crc[doc_id, at, len(part) // 4, zlib.crc32(part)] += 1
    for r in rows:
        crc[r.doc_id, r.start, r.length, r.ids_crc32] -= 1
    assert not any(crc.values())
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        ends = list(itertools.accumulate(n for _, n in sorted(pieces)))
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 1024
    return len(sequences)


def packed(spark, tmp_path, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    packing.tokenised(frame).write.parquet(f"{tmp_path}/pieces")
    return packing.pack(spark.read.parquet(f"{tmp_path}/pieces")).collect()


def test_pieces(spark, tmp_path, tokenizer):
    rng = random.Random(3)
    docs = [(i, "word " * int(rng.expovariate(1 / 500))) for i in range(150)]
    docs += [(3, "again"), (3, "again"), (None, None), (None, "x"), (9, "")]
    rows = packed(spark, tmp_path, docs)
    n = check_pieces(rows, docs, tokenizer)
    tokens = sum(r.length for r in rows)
    assert n * 1024 <= tokens * 1.03


def test_exact_multiples_and_nothing(spark, tmp_path, tokenizer):
    docs = [(i, " a" * (1024 * i - 1)) for i in range(1, 4)]
    assert check_pieces(packed(spark, tmp_path, docs), docs, tokenizer) == 6
    assert packed(spark, tmp_path / "none", []) == []


def test_given_table_has_little_padding(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    packing.tokenised(docs).write.parquet(f"{tmp_path}/p")
    rows = packing.pack(spark.read.parquet(f"{tmp_path}/p")).select("sequence_id", "length").collect()
    tokens = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) * 1024 < tokens * 1.01


@pytest.mark.parametrize("seed", range(4))
def test_patterns_hold_every_item_once(seed):
    rng = random.Random(seed)
    histogram = {s: rng.randrange(0, 200) for s in rng.sample(range(1, 129 if seed else 50), 40)}
    plan = packing.patterns(histogram, 128)
    held = defaultdict(int)
    for pattern, times in plan:
        assert times > 0 and sum(s * n for s, n in pattern.items()) <= 128
        for s, n in pattern.items():
            held[s] += n * times
    assert held == {s: n for s, n in histogram.items() if n}
    # No two items over half of a sequence share one.
    volume = sum(s * n for s, n in histogram.items()) / 128
    least = max(volume, sum(n for s, n in histogram.items() if s > 64))
    assert sum(times for _, times in plan) <= least * (1.01 if seed == 0 else 1.15) + 1


def test_patterns_reach_a_known_optimum():
    # Two of 51 never share a sequence of 100; each leaves room for one of 49.
    assert sum(t for _, t in packing.patterns({51: 40, 49: 40}, 100)) == 40
    assert packing.patterns({}, 100) == []
