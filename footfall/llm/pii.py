"""Personal data in texts, plain and disguised.

Plain identifiers are found by pattern. Disguised ones are found in a normalised
copy of the text: look-alike letters and foreign digits become ASCII, zero-width
characters go, spelled-out digits become digits, and spellings of @ and . become
those signs. The copy remembers which source characters every stretch of it came
from, so a span found there is reported as a span of the source.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from footfall.llm.spans import Span, in_order, with_masked, with_spans

KINDS = ("email", "ip", "card", "phone")

# The plain patterns' character classes, limits and repeats.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Every four numbers, from the left, of each chain of numbers and dots."""
    for m in _DOTTED.finditer(text):
        if m.group().count(".") >= 3:
            parts, at = m.group().split("."), m.start()
            for i in range(0, len(parts) - 3, 4):
                found = ".".join(parts[i : i + 4])
                if _is_ip(found):
                    yield at, at + len(found)
                at += len(found) + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _is_ip(found: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in found.split(".")))


def _is_card(found: str) -> bool:
    digits = _NOT_DIGIT.sub("", found)
    return 14 <= len(digits) <= 19 and _luhn(digits)


def _is_phone(found: str) -> bool:
    return 10 <= len(_NOT_DIGIT.sub("", found)) <= 15


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """What the plain patterns find, leftmost and without overlap in each kind."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", a, b) for a, b in _ips(text)]
    for kind, pattern, holds in (
        ("card", _CARD, _is_card),
        ("phone", _PHONE, _is_phone),
    ):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if holds(m.group())]
    return out


# Letters of other scripts that look like Latin ones.
_LOOKALIKE = dict(
    zip(
        "аеорсухіјѕһԁԛԝАВЕКМНОРСТХІЈЅ" "οαικνρυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijshdqwABEKMHOPCTXIJS" "oaiknpuABEZHIKMNOPTYX",
    )
)
# Other forms of the two signs.
_SIGNS = {"﹫": "@", "․": ".", "。": ".", "｡": "."}
# Digits as words.
_DIGIT_WORDS = {
    w: str(d)
    for d, w in enumerate("zero one two three four five six seven eight nine".split())
}


def _same_length_forms() -> dict[str, str]:
    """Single characters that stand for one ASCII character."""
    table = _LOOKALIKE | _SIGNS
    for code in [*range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)]:
        plain = unicodedata.normalize("NFKC", chr(code))
        if len(plain) == 1 and plain.isascii():
            table[chr(code)] = plain
    for code in range(0x80, sys.maxunicode + 1):
        if unicodedata.category(chr(code)) == "Nd":
            table[chr(code)] = str(unicodedata.digit(chr(code)))
    return table


# Zero-width characters.
_HIDDEN = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
_NUMBER = "(?:" + "|".join(_DIGIT_WORDS) + ")"
_REWRITE = re.compile(
    rf"""
      (?P<hidden>[{_HIDDEN}]+)
    | (?P<at>\s{{0,3}}[\[({{<]\s{{0,3}}(?:at|@)\s{{0,3}}[\])}}>]\s{{0,3}}
        | (?<=[a-z0-9])\s{{1,3}}at\s{{1,3}}(?=[a-z0-9-]{{1,63}}
            (?:\s{{1,3}}dot\s{{1,3}}|\s{{0,3}}[\[({{<]\s{{0,3}}dot\s{{0,3}}[\])}}>])))
    | (?P<weak>(?<=[a-z0-9])\s{{1,3}}at\s{{1,3}}(?=[a-z0-9-]{{1,63}}\.[a-z]{{2}}))
    | (?P<dot>\s{{0,3}}[\[({{<]\s{{0,3}}(?:dot|\.)\s{{0,3}}[\])}}>]\s{{0,3}}
        | (?<=[a-z0-9])\s{{1,3}}dot\s{{1,3}}(?=[a-z0-9]))
    | (?P<run>\b(?:plus\s{{1,3}})?{_NUMBER}\b
        (?:[\s,-]{{1,3}}(?:{_NUMBER}|dot|point|dash|[0-9]+)\b){{3,}}
        | (?:\bplus\s{{1,3}}|\+)[0-9]+(?:[\s,-]{{1,3}}(?:{_NUMBER}|[0-9]+)\b){{3,}})
    """,
    re.I | re.A | re.X,
)
_RUN_PART = re.compile(rf"plus|\+|dot|point|dash|{_NUMBER}|[0-9]+", re.I | re.A)
_RUN_SIGNS = {"plus": "+", "+": "+", "dot": ".", "point": ".", "dash": "-"}
_BRACKETED = re.compile(r"[\[({<]\s{0,3}(?:at\b|@|\.)", re.I)
# A run of digits only, behind its plus; and what any other run has.
_PLUS_DIGITS = re.compile(r"(?:plus\s{1,3}|\+)[0-9]+[\s,-]", re.I | re.A)
_NUMBER_WORD = re.compile(rf"\b{_NUMBER}\b", re.I | re.A)
# After a bare "at" before a plain domain, only a name like an account's counts, or
# one of letters behind a word for writing to somebody.
_BARE_AT = re.compile(r"at\s{1,3}[a-z0-9-]{1,63}\.[a-z]{2}")
_ACCOUNT = re.compile(r"[0-9._%+-]")
_WRITE_TO = re.compile(
    r"\b(?:(?:e-?mail|mail|mailbox|address)(?:\s{1,3}address)?(?:\s{0,3}[:=]|\s{1,3}is\b)"
    r"|mailto:|contact:?|(?:write|mail|e-?mail)\s{1,3}to)\s{0,3}\Z",
    re.I | re.A,
)
_SOMEBODY = frozenset("me us him her it them you is to are was be or and not only here there".split())


def _may_be_rewritten(text: str) -> bool:
    """A cheap test that holds for every text in which ``_REWRITE`` finds anything."""
    if not text.isascii() and any(c in text for c in _HIDDEN):
        return True
    lower = text.lower()
    if "dot" in lower or any(c in text for c in "[({<") and _BRACKETED.search(text):
        return True
    if _BARE_AT.search(lower):
        return True
    if ("+" in text or "plus" in lower) and _PLUS_DIGITS.search(text):
        return True
    return any(word in lower for word in _DIGIT_WORDS) and bool(_NUMBER_WORD.search(text))


class Normalised:
    """A normalised text and the way back to its source.

    ``starts[i]`` is where piece ``i`` begins in ``text``, ``sources[i]`` the
    source span it stands for, and ``changed[i]`` whether it was rewritten.
    """

    def __init__(self, source: str, swaps: dict[str, str]) -> None:
        spots: list[int] = []
        if not source.isascii() and not swaps.keys().isdisjoint(source):
            spots = [i for i, c in enumerate(source) if c in swaps]
            source = "".join([swaps.get(c, c) for c in source])
        self.spots = spots  # swapped one for one, so at the same place
        self.weak: set[int] = set()  # where @ stands for a bare "at"
        self.starts: list[int] = []
        self.sources: list[tuple[int, int]] = []
        self.changed: list[bool] = []
        out: list[str] = []
        length = 0

        def put(text: str, a: int, b: int, changed: bool) -> None:
            nonlocal length
            self.starts.append(length)
            self.sources.append((a, b))
            self.changed.append(changed)
            out.append(text)
            length += len(text)

        at = 0
        for m in _REWRITE.finditer(source) if _may_be_rewritten(source) else ():
            if m.start() > at:
                put(source[at : m.start()], at, m.start(), False)
            at = m.end()
            if m.lastgroup == "run":
                for part in _RUN_PART.finditer(m.group()):
                    word = part.group().lower()
                    sign = _RUN_SIGNS.get(word) or _DIGIT_WORDS.get(word)
                    a, b = m.start() + part.start(), m.start() + part.end()
                    put(sign or word, a, b, sign is not None)
            elif m.lastgroup != "hidden":
                if m.lastgroup == "weak":
                    self.weak.add(length)
                put("." if m.lastgroup == "dot" else "@", *m.span(), True)
            else:
                put("", *m.span(), True)
        put(source[at:], at, len(source), False)
        self.text = "".join(out)

    @property
    def same(self) -> bool:
        return not self.spots and not any(self.changed)

    def back(self, a: int, b: int) -> tuple[int, int, bool]:
        """The source span of ``text[a:b]`` and whether anything in it was disguised."""
        i = bisect_right(self.starts, a) - 1
        j = bisect_right(self.starts, b - 1) - 1
        start, stop = self.sources[i][0], self.sources[j][1]
        if not self.changed[i]:
            start += a - self.starts[i]
        if not self.changed[j]:
            stop = self.sources[j][0] + b - self.starts[j]
        k = bisect_right(self.spots, start - 1)
        swapped = k < len(self.spots) and self.spots[k] < stop
        return start, stop, swapped or any(self.changed[i : j + 1])


def _is_account(text: str, a: int, at: int) -> bool:
    """Whether ``text[a:at]``, before a bare "at", is meant as an address."""
    name = text[a:at]
    if _ACCOUNT.search(name):
        return True
    return name.lower() not in _SOMEBODY and bool(_WRITE_TO.search(text[max(0, a - 40) : a]))


def make_finder() -> Callable[[str], list[Span]]:
    swaps = _same_length_forms()

    def find(text: str) -> list[Span]:
        plain = set(plain_spans(text))
        spans = {(*s, True) for s in plain}
        copy = Normalised(text, swaps)
        if not copy.same:
            for kind, a, b in plain_spans(copy.text):
                at = copy.text.find("@", a, b)
                if kind == "email" and at in copy.weak and not _is_account(copy.text, a, at):
                    continue
                start, stop, disguised = copy.back(a, b)
                if disguised and (kind, start, stop) not in plain:
                    spans.add((kind, start, stop, False))
        return in_order(spans, KINDS)

    return find


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii``, the spans of personal data in each whole ``text``.

    Null and empty texts have none. A disguised span is added only if it holds a
    rewritten character and no plain span is the same. All rows and other columns
    stay, repeated rows too; a column named ``pii`` is replaced.
    """
    return with_spans(docs, "pii", make_finder)


def mask_personal_data(
    docs: DataFrame, *others: Callable[[], Callable[[str], list[Span]]]
) -> DataFrame:
    """``docs`` with every span that ``find_personal_data`` finds masked in ``text``, in one pass.

    So are the spans of ``others``, each a function that makes a finder in a task.
    """

    def make_all() -> Callable[[str], list[Span]]:
        finders = [make() for make in (make_finder, *others)]
        return lambda text: [span for find in finders for span in find(text)]

    return with_masked(docs, make_all)
