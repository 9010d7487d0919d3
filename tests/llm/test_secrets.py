"""Secrets: plain patterns by brute force, random strings by example."""

import base64
import hashlib
import random
import re
import string

import pytest
from hypothesis import given, settings, strategies as st

from footfall.llm import secret_scan

pytest.importorskip("tiktoken")
FIND = secret_scan._finder(None)


def brute(text):
    out = []
    for m in re.finditer(
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        text,
    ):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))


def base(text):
    return [s[:3] for s in FIND(text) if s[3]]


@settings(max_examples=500, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["token", "Secret", "PASSWD", "api_key", "APIKEY", "=", ":", " ", '"', "'", "ab", "1f", "AKIA",
             "Z9Z9Z9", "0123456789abcdef", "K", "tokén", "passw", "é", "."]
        ),
        max_size=14,
    ).map("".join)
)
def test_plain_spans_are_the_patterns(text):
    assert base(text) == brute(text)


def test_plain_spans_in_the_given_texts(spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert base(row.text) == brute(row.text)


def test_random_strings_are_found():
    rng = random.Random(5)
    for _ in range(40):
        secret = "".join(rng.choices(string.ascii_letters + string.digits, k=32))
        added = [(k, a, b) for k, a, b, plain in FIND(f"use {secret} here") if not plain]
        assert added == [("random", 4, 36)]
    raw = base64.b64encode(rng.randbytes(40)).decode()
    assert any(k == "random" for k, *_ in FIND(f"key {raw}"))


@pytest.mark.parametrize("length", [24, 32])
@pytest.mark.parametrize(
    "before",
    [
        "/integrations/notifications/", "session_credential_for_production=", "/home/deploy/application/config/",
        "internal-service-account-", "/integrations/" * 40,
    ],
)
def test_random_strings_behind_readable_parts(before, length):
    rng = random.Random(length)
    bare = found = 0
    for _ in range(100):
        secret = "".join(rng.choices(string.ascii_letters + string.digits, k=length))
        bare += FIND(secret) == [("random", 0, length, False)]
        for after in ("", "/settings/application"):
            spans = FIND(before + secret + after)
            found += spans == [("random", len(before), len(before) + length, False)]
    assert bare >= 98 and found >= 2 * bare


def test_stretches_of_parts():
    rng = random.Random(8)
    for scores in ([rng.choice([-7, -3, -1, 0, 1, 2, 6]) for _ in range(rng.randrange(1, 12))] for _ in range(300)):
        stretches = secret_scan._maximal(scores)
        best = max(sum(scores[i : j + 1]) for i in range(len(scores)) for j in range(i, len(scores)))
        assert all(a[1] < b[0] for a, b in zip(stretches, stretches[1:]))
        assert all(sum(scores[i : j + 1]) >= 0 for i, j in stretches)
        assert best < 0 or best in [sum(scores[i : j + 1]) for i, j in stretches]


@pytest.mark.parametrize(
    "text",
    [
        "/repository/project/settings/commit/" + hashlib.sha1(b"x").hexdigest().upper() + "/files/application/overview/documents",
        "/customers/accounts/550e8400-e29b-41d4-a716-446655440000/statements/overview",
        "/some/long/readable/path/with/version/v2/and/documents", "/archive/2024-01-01T00-00-00_some-long-name/files",
    ],
)
def test_known_shapes_behind_readable_parts_are_not(text):
    assert [s for s in FIND(text) if not s[3]] == []


@pytest.mark.parametrize(
    "text",
    [
        hashlib.sha256(b"x").hexdigest().upper(), "550e8400-e29b-41d4-a716-446655440000",
        "some_long_identifier_name_2024", "ThisIsAVeryLongCamelCaseIdentifier", "internationalisation",
        "2024-01-01T00-00-00_some-long-name", "sha256-" + base64.b64encode(bytes(range(32))).decode(), "", " ",
        "1234567890123456789012", "a" * 50_000,
    ],
)
def test_known_or_readable_strings_are_not(text):
    assert [s for s in FIND(text) if not s[3]] == []


def test_frame(spark):
    rows = [(1, "token = abcdef1", "s"), (1, "token = abcdef1", "s"), (None, None, None), (2, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets string")
    found = secret_scan.find_secrets(docs)
    assert found.columns == ["doc_id", "text", "secrets"]
    assert sorted(len(r.secrets) for r in found.collect()) == [0, 0, 1, 1]
    assert secret_scan.find_secrets(spark.createDataFrame([], docs.schema)).collect() == []
    FIND("Ab1" * 200_000)
    FIND("documents/xq/" * 50_000 + "7")
