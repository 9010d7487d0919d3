"""Language identification: held-out accuracy, codewords, edges."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import language
from footfall.llm.queries import QUERIES


@pytest.mark.parametrize("n", range(2, 30))
def test_codewords_differ(n):
    code = language.codewords(n)
    distance = (code.shape[1] - code @ code.T) / 2
    apart = distance[~np.eye(n, dtype=bool)].min()
    assert apart >= (1 if n == 2 else 2 if n <= 3 else 3)
    assert (np.abs(code.sum(axis=0)) < n).all()


def test_a_wrong_bit_is_corrected():
    """With one classifier turned round, the nearest codeword is still the right one."""
    code = language.codewords(4)
    for row in range(4):
        for bit in range(code.shape[1]):
            margins = code[row].copy()
            margins[bit] *= -1
            loss = np.logaddexp(0, -margins * code).sum(axis=1)
            assert loss.argmin() == row


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op9_language_id"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(docs, "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_stretches_do_not_depend_on_the_cut(monkeypatch):
    texts = ["abc def", "", None, "é" * 50, "The quick brown fox " * 20, "z"]
    data, offsets = language.string_bytes(pa.array(texts))

    def counts():
        out = np.zeros((len(texts), language.BUCKETS))
        for bucket, rows in language._stretches(data, offsets):
            np.add.at(out, (rows, bucket), bucket != 0)
        return out

    whole = counts()
    monkeypatch.setattr(language, "PIECE", 7)
    assert (counts() == whole).all()


def test_edges(spark):
    learn = [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("le chien et le chat", "fr")] * 3
    learn += [(None, "en"), ("text", None)]
    model = language.fit_languages(spark.createDataFrame(learn, "text string, lang string"))
    assert model.languages == ("de", "en", "fr")
    docs = [
        (1, "the dog", "x"), (1, "the dog", "x"), (2, None, None), (3, "", ""), (4, "123 !?", ""),
        (None, "und die", ""), (5, "漢字", ""), (6, "der " * 300_000, ""),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang_pred string")
    rows = language.identify(frame, model).collect()
    assert len(rows) == len(docs)
    by_text = {r.text: r for r in rows}
    assert by_text["the dog"].lang_pred == "en" and by_text["und die"].lang_pred == "de"
    assert by_text["der " * 300_000].lang_pred == "de"
    for text in (None, "", "123 !?"):
        assert tuple(by_text[text])[2:] == ("und", 0.0, False)
    assert by_text["漢字"].lang_pred in model.languages and by_text["漢字"].lang_ambiguous
    assert language.identify(frame.limit(0), model).collect() == []


@pytest.mark.parametrize("rows", [[], [("only one language", "en")]])
def test_few_languages(spark, rows):
    model = language.fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    frame = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.lang_ambiguous) for r in language.identify(frame, model).collect()}
    assert found == {1: (rows[0][1] if rows else "und", False), 2: ("und", False)}


def trigrams(text):
    """Buckets of a text's trigrams that have a letter, byte by byte."""
    codes = [0, 0, *((b | 32) - 96 if chr(b).isascii() and chr(b).isalpha() else b if b > 127 else 0 for b in text.encode()), 0, 0]
    packed = [(a << 16) | (b << 8) | c for a, b, c in zip(codes, codes[1:], codes[2:])]
    return [b for b in ((x * 2654435761 % 2**32) >> 18 for x in packed if x) if b]


def brute(learn, texts):
    """(language, score, ambiguous) by dictionaries, one text after the other."""
    names = sorted({lang for text, lang in learn if text is not None and lang})
    shares = {}
    for name in names:
        own = [trigrams(text) for text, lang in learn if lang == name and text is not None]
        shares[name] = Counter()
        for found in own:
            for b in found:
                shares[name][b] += 1 / len(found) / len(own)
    code, low = language.codewords(len(names)), language.SMOOTHING / language.BUCKETS

    def weight(bit, b):
        sides = [[shares[n][b] + low for n, c in zip(names, code[:, bit]) if c == side] for side in (1, -1)]
        yes, no = (max(sum(x) / len(x), low) for x in sides)
        return math.log(yes) - math.log(no)

    for text in texts:
        found = trigrams(text)
        margins = [
            language.SHARPNESS * sum(weight(bit, b) for b in found) / max(len(found), 1)
            for bit in range(code.shape[1])
        ]
        loss = [sum(math.log1p(math.exp(-m * c)) for m, c in zip(margins, row)) for row in code]
        order = sorted(range(len(names)), key=loss.__getitem__)
        score = 1 / sum(math.exp(loss[order[0]] - x) for x in loss)
        yield names[order[0]], score, loss[order[1]] - loss[order[0]] < language.AMBIGUOUS


@pytest.mark.parametrize("n", [2, 3, 4, 8])
def test_against_dictionaries(spark, n):
    rng = random.Random(n)
    kinds = [rng.sample("abcdefghijklmnopqrstuvwxyzéßЖ", 9) for _ in range(n)]

    def text(kind):
        return " ".join("".join(rng.choices(kinds[kind], k=rng.randrange(1, 6))) for _ in range(rng.randrange(1, 30)))

    learn = [(text(i % n), f"l{i % n}") for i in range(60)] + [(None, "l0"), ("x", None)]
    texts = [text(rng.randrange(n)) for _ in range(50)] + [text(0) + " " + text(1), "Q"]
    model = language.fit_languages(spark.createDataFrame(learn, "text string, lang string").repartition(5))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in language.identify(rows, model).collect()}
    for i, (lang, score, close) in enumerate(brute(learn, texts)):
        r = found[i]
        assert math.isclose(r.lang_score, score, rel_tol=1e-4)
        if abs(score - 0.5) > 1e-3:
            assert (r.lang_pred, r.lang_ambiguous) == (lang, close)
