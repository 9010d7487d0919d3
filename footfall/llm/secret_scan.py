"""Secrets in texts: known shapes, and strings that a tokenizer finds hard to compress.

A byte-pair vocabulary packs language into few tokens. A random string falls apart
into many, so few characters per token give it away. Readable parts that are glued
on, such as a path or a name before "=", are told apart and do not count. Digests and
identifiers that are random but no secret are left out.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from footfall.llm.spans import Span, in_order, with_spans

KINDS = ("assign", "access", "hex", "random")

# The plain patterns and the lengths they must reach.
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_LEAST = 6

LEAST_CHARACTERS = 20
MOST_PER_TOKEN = 2.0  # characters; language has more
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_CHARACTERS},}}")
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])|(?=.*[a-z][A-Z])(?=.*[A-Z][a-z])", re.S)
# Digests by length, UUIDs, dates with what follows, and plain hexadecimal numbers.
_KNOWN = re.compile(
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|(?:sha(?:1|256|384|512)|md5)[-=_][A-Za-z0-9+/=]+"
    r"|[0-9]{4}-[0-9]{2}-[0-9]{2}[A-Za-z0-9_-]*"
)
# Parts of a run; the known shapes within it, each a part of its own, dates without what follows.
_PART = re.compile(
    r"(?P<known>(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
    r"|[0-9]{4}-[0-9]{2}-[0-9]{2}(?:T[0-9]{2}-[0-9]{2}(?:-[0-9]{2})?Z?)?)(?![A-Za-z0-9])"
    r"|(?:sha(?:1|256|384|512)|md5)[-=_][A-Za-z0-9+/=]+)"
    r"|[A-Za-z0-9]+"
)


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """What the plain patterns find, leftmost and without overlap in each kind."""
    lower = text.lower()
    out = []
    if any(word in lower for word in ("passw", "secret", "token", "api_key", "apikey")):
        out += [
            ("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= _ASSIGN_LEAST
        ]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def load_encoder(vocabulary: str | None):
    """A tiktoken encoder of the rank file at ``vocabulary``, by default the public 50k one."""
    import public_tokenizers
    import tiktoken

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def _padded(run: str, end: int) -> int:
    """Where base64 padding at ``end`` ends, if nothing is glued on to it."""
    stop = end
    while stop < len(run) and run[stop] == "=":
        stop += 1
    return stop if stop == len(run) or run[stop] == "/" else end


def _maximal(scores: list[float]) -> list[tuple[int, int]]:
    """First and last places of all maximal stretches whose scores add up to 0 at least.

    After Ruzzo and Tompa: no such stretch gets a higher sum by being longer or
    shorter, and none overlap.
    """
    # First, last, sum before, sum with it, and the next one to the left whose sum before is not higher.
    found: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for place, score in enumerate(scores):
        before, total = total, total + score
        if score < 0:
            continue
        first, low = place, before
        while True:
            at = len(found) - 1
            while at >= 0 and found[at][2] > low:
                at = found[at][4]
            if at < 0 or found[at][3] > total:
                break
            first, low = found[at][0], found[at][2]
            del found[at:]
        found.append((first, place, low, total, at))
    return [(first, last) for first, last, *_ in found]


def _finder(vocabulary: str | None) -> Callable[[str], list[Span]]:
    encoder = load_encoder(vocabulary)

    def tokens(found: str) -> int:
        # Slices keep the merging of a very long run linear.
        return sum(len(encoder.encode_ordinary(found[i : i + 512])) for i in range(0, len(found), 512))

    def random_looking(found: str) -> bool:
        if not _MIXED.match(found) or _KNOWN.fullmatch(found):
            return False
        return len(found) <= MOST_PER_TOKEN * tokens(found)

    def stretches(run: str) -> list[tuple[int, int]]:
        """The random stretches of a run, without the readable parts around them."""
        if not _MIXED.match(run) or _KNOWN.fullmatch(run):
            return []
        parts = [
            (*m.span(), -len(run) if m["known"] else MOST_PER_TOKEN * tokens(m.group()) - len(m.group()))
            for m in _PART.finditer(run)
        ]
        if random_looking(run):
            # Readable parts at its ends go as long as enough is left.
            first, last = 0, len(parts) - 1
            while first < last and parts[first][2] < 0:
                first += 1
            while first < last and parts[last][2] < 0:
                last -= 1
            a = parts[first][0] if first else 0
            b = _padded(run, parts[last][1]) if last < len(parts) - 1 else len(run)
            return [(a, b)] if random_looking(run[a:b]) and b - a >= LEAST_CHARACTERS else [(0, len(run))]
        return [
            (a, b)
            for a, b in ((parts[i][0], _padded(run, parts[j][1])) for i, j in _maximal([p[2] for p in parts]))
            if b - a >= LEAST_CHARACTERS and random_looking(run[a:b])
        ]

    def find(text: str) -> list[Span]:
        plain = plain_spans(text)
        spans: set[Span] = {(*s, True) for s in plain}
        for m in _CANDIDATE.finditer(text):
            for a, b in stretches(m.group()):
                a, b = a + m.start(), b + m.start()
                if not any(s < b and a < e for _, s, e in plain):
                    spans.add(("random", a, b, False))
        return in_order(spans, KINDS)

    return find


def make_finder(vocabulary: str | None = None) -> Callable[[], Callable[[str], list[Span]]]:
    """What makes the finder of ``find_secrets`` in a task."""
    return lambda: _finder(vocabulary)


def find_secrets(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs`` with ``secrets``, the spans of secrets in each whole ``text``.

    ``vocabulary`` is the path of a tiktoken rank file that executors can read. A
    random-looking string is added where no plain span overlaps it. Null and empty
    texts have no spans; all rows and other columns stay, repeated rows too; a
    column named ``secrets`` is replaced.
    """
    return with_spans(docs, "secrets", make_finder(vocabulary))
