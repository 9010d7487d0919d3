"""Typed filter conditions of a run."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F


def _blank(value: object) -> bool:
    return value is None or (isinstance(value, str) and not value.strip())


def _text(value: object) -> str | None:
    return None if _blank(value) else str(value).strip()


def _whole(key: str, value: object) -> int | None:
    """A whole number, as a number or as text; ``20.0`` is one."""
    if _blank(value):
        return None
    try:
        number = Decimal(str(value).strip())
        if number == number.to_integral_value():
            return int(number)
    except ArithmeticError:
        pass
    raise ValueError(f"{key} is not a whole number: {value!r}")


def _names(value: object) -> tuple[str, ...]:
    """A list of names, or comma-separated text whose items may be quoted."""
    if _blank(value):
        return ()
    items: Iterable[str]
    if isinstance(value, str):
        items = (_unquoted(found.group().strip()) for found in _ITEM.finditer(value))
    else:
        items = (str(part) for part in value)
    return tuple(item.strip() for item in items if item.strip())


def _pages(key: str, value: object) -> tuple[int, ...]:
    """A list of page numbers, or comma-separated text."""
    if _blank(value):
        return ()
    items = value.split(",") if isinstance(value, str) else value
    pages = (_whole(key, item) for item in items)
    return tuple(page for page in pages if page is not None)


def _unquoted(item: str) -> str:
    """An item without the quotes it stands in; a quote inside is written twice."""
    if len(item) > 1 and item[0] in "'\"" and item[-1] == item[0]:
        return item[1:-1].replace(item[0] * 2, item[0])
    return item


# An item of a list in text: quoted, each in its own way, or up to the next comma.
_ITEM = re.compile(r"""\s*(?:"(?:[^"]|"")*"|'(?:[^']|'')*')\s*(?=,|$)|[^,]+""")


def _all_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left & right, predicates, F.lit(True))


@dataclass(frozen=True)
class Conditions:
    """Date bounds on actions; age bounds and professions on their users.

    Bounds are inclusive. Whatever is ``None`` or empty does not filter. ``page_flow``
    filters nothing: it names the pages whose conversion a run reports, if any.
    ``raw_json`` keeps the caller's text, unread keys included, so that the
    statistics row can carry it unchanged.
    """

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    raw_json: str | None = None
    page_flow: tuple[int, ...] = ()

    @classmethod
    def from_dict(cls, values: Mapping[str, object], raw_json: str | None = None) -> Conditions:
        return cls(
            start_date=_text(values.get("startDate")),
            end_date=_text(values.get("endDate")),
            start_age=_whole("startAge", values.get("startAge")),
            end_age=_whole("endAge", values.get("endAge")),
            professionals=_names(values.get("professionals")),
            raw_json=raw_json,
            page_flow=_pages("targetPageFlow", values.get("targetPageFlow")),
        )

    @classmethod
    def from_json(cls, text: str) -> Conditions:
        return cls.from_dict(json.loads(text), raw_json=text)

    def to_json(self) -> str:
        if self.raw_json is not None:
            return self.raw_json
        values = {
            "startDate": self.start_date,
            "endDate": self.end_date,
            "startAge": self.start_age,
            "endAge": self.end_age,
            "professionals": list(self.professionals) or None,
            "targetPageFlow": list(self.page_flow) or None,
        }
        return json.dumps(
            {key: value for key, value in values.items() if value is not None},
            ensure_ascii=False,
        )

    def on_actions(self) -> Column:
        """The part that reads action columns. Dates compare as text."""
        predicates = []
        if self.start_date is not None:
            predicates.append(F.col("date") >= self.start_date)
        if self.end_date is not None:
            predicates.append(F.col("date") <= self.end_date)
        return _all_of(predicates)

    def on_users(self) -> Column:
        """The part that reads user columns."""
        predicates = []
        if self.start_age is not None:
            predicates.append(F.col("age") >= self.start_age)
        if self.end_age is not None:
            predicates.append(F.col("age") <= self.end_age)
        if self.professionals:
            predicates.append(F.col("professional").isin(list(self.professionals)))
        return _all_of(predicates)
