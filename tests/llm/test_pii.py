"""Personal data: plain patterns by brute force, disguises by example."""

import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from footfall.llm import pii, spans

FIND = pii.make_finder()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def base(text):
    return [s[:3] for s in FIND(text) if s[3]]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab1290.@-+ (%é", max_size=60))
def test_plain_spans_are_the_patterns(text):
    assert base(text) == brute(text)


def test_plain_spans_in_the_given_texts(spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert base(row.text) == brute(row.text)


def test_plain_numbers():
    rng = random.Random(1)
    for _ in range(300):
        digits = "".join(rng.choice("0123456789") for _ in range(rng.randrange(12, 22)))
        text = f"x {digits[:4]}-{digits[4:8]} {digits[8:]} y +{digits[:12]} 1.2.3.{digits[:3]}.4.5"
        assert base(text) == brute(text)


DISGUISED = [
    ("mail john.x [at] example [dot] com now", "email", "john.x [at] example [dot] com"),
    ("mail john (AT) example (DOT) co (dot) uk.", "email", "john (AT) example (DOT) co (dot) uk"),
    ("write john[@]example[.]com now", "email", "john[@]example[.]com"),
    ("john (@) example.com", "email", "john (@) example.com"),
    ("john{ @ }example.com", "email", "john{ @ }example.com"),
    ("e-mail: alice at gmail.com", "email", "alice at gmail.com"),
    ("please contact alice at gmail.com today", "email", "alice at gmail.com"),
    ("my email address is alice at gmail.com", "email", "alice at gmail.com"),
    ("john at example dot com", "email", "john at example dot com"),
    ("ask john.x at example.com today", "email", "john.x at example.com"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("jo\u200bhn@example.com", "email", "jo\u200bhn@example.com"),
    ("call plus one five five five one two three four five six seven!", "phone",
     "plus one five five five one two three four five six seven"),
    ("+１ ５５５ １２３ ４５６７", "phone", "+１ ５５５ １２３ ４５６７"),
    ("four one one one one one one one one one one one one one one one", "card",
     "four one one one one one one one one one one one one one one one"),
    ("one nine two dot 168 dot one dot one", "ip", "one nine two dot 168 dot one dot one"),
]


@pytest.mark.parametrize("text, kind, piece", DISGUISED)
def test_disguises(text, kind, piece):
    added = [(k, text[a:b]) for k, a, b, plain in FIND(text) if not plain]
    assert (kind, piece) in added


@pytest.mark.parametrize(
    "text",
    [
        "we met at noon in a polka dot dress", "one two three go", "at example dot", "Он пришёл в 10.30",
        "write to me at example.com", "email us at example.com", "mails arrive at example.com", "a (@) b", "[@]",
        "look at example.com", "we met at noon.Then", "look (at) this", "version 1.2.3", "a [dot] in brackets", "zero one", "", " ", "x" * 100_000,
    ],
)
def test_clean_texts_have_none(text):
    assert FIND(text) == []


def test_long_runs_are_linear():
    for text in ("a" * 400_000 + " @ b", "1" * 400_000, "1." * 200_000, "+1" + "(" * 400_000, "@" * 300_000):
        FIND(text)


def test_frame_and_mask(spark):
    rows = [(1, "me@x.org and +1 555 123 4567", "p"), (2, None, None), (2, None, None), (None, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    found = pii.find_personal_data(docs)
    assert found.columns == ["doc_id", "text", "pii"] and found.count() == 4
    masked = pii.mask_personal_data(docs)
    assert masked.columns == docs.columns
    expected = [(1, "<EMAIL> and <PHONE>", "p"), (2, None, None), (2, None, None), (None, "", "")]
    assert sorted(map(tuple, masked.collect()), key=str) == sorted(expected, key=str)
    assert pii.find_personal_data(spark.createDataFrame([], docs.schema)).collect() == []


def test_mask_of_overlapping_spans():
    found = [("card", 2, 6, True), ("phone", 4, 8, False)]
    assert spans.mask("ab123456cd", found) == "ab<CARD>cd"


PARTS = st.sampled_from(
    "plus Plus + one two (one four) five. 49 30 123 45678 , - dot point dash at @ [at] (.) { . gmail.com bob é éone\u200b"
    " \u00a0 Zero zero- ,nine stone plus+ <at> a1".split(" ")
)


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.tuples(PARTS, st.sampled_from(["", " ", "  ", "\n", ", ", "-"])), max_size=12))
def test_no_rewriting_escapes_the_cheap_test(parts):
    text = "".join(a + b for a, b in parts)
    if pii._REWRITE.search(text):
        assert pii._may_be_rewritten(text)


@pytest.mark.parametrize("call", ["call plus 49 30 123 45678 now", "call +49, 30, 123, 45678 now"])
def test_a_span_does_not_depend_on_other_words(call):
    found = FIND(call)
    assert [k for k, *_ in found] == ["phone"]
    assert FIND(call + " a dot here") == found and FIND(call + " one") == found
