"""Spans found in texts: how they are kept, counted, digested and masked.

A span is a kind, a start and an end (code points, end exclusive) and whether a
plain pattern alone finds it (``base``). Spans stand by start, then by the order
in which their finder lists its kinds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.textbytes import row_groups

_GROUP = 1 << 20  # bytes of text looked at together

Span = tuple[str, int, int, bool]

_TYPE = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]
    )
)
_DDL = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def in_order(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def with_spans(
    docs: DataFrame, name: str, make_finder: Callable[[], Callable[[str], list[Span]]]
) -> DataFrame:
    """``docs`` with a column ``name`` of the spans in ``text``; a null text has none.

    ``make_finder`` is called once in each task. A column of that name in
    ``docs`` is replaced; other columns and all rows stay.
    """
    docs = docs.drop(name)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = make_finder()
        for batch in batches:
            for part in row_groups(batch, "text", _GROUP):
                found = _found(part.column("text"), finder)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, found], names=[*part.schema.names, name]
                )

    return docs.mapInArrow(run, ", ".join([*fields, f"`{name}` {_DDL}"]))


def _found(texts: pa.Array, finder: Callable[[str], list[Span]]) -> pa.Array:
    """The spans of each text; columns of plain values take little room while they grow."""
    ends = [0]
    fields: tuple[list, ...] = ([], [], [], [])
    for text in texts:
        for span in finder(text.as_py()) if text.is_valid else ():
            for values, value in zip(fields, span):
                values.append(value)
        ends.append(len(fields[0]))
    parts = [pa.array(values, field.type) for values, field in zip(fields, _TYPE.value_type)]
    spans = pa.StructArray.from_arrays(parts, fields=list(_TYPE.value_type))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def count_base(spans: Column, kind: str) -> Column:
    own = F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))
    return F.size(own).cast("long")


def mask(text: str, spans: Iterable[Span]) -> str:
    """``text`` with every stretch that spans cover replaced by its first span's ``<KIND>``."""
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def with_masked(docs: DataFrame, make_finder: Callable[[], Callable[[str], list[Span]]]) -> DataFrame:
    """``docs`` with what the finder finds masked in ``text``; nulls, rows and columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = make_finder()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in row_groups(batch, "text", _GROUP):
                texts = []
                for value in part.column("text"):
                    text = value.as_py()
                    spans = finder(text) if text else ()
                    texts.append(mask(text, spans) if spans else text)
                new = pa.array(texts, batch.schema.field("text").type)
                yield part.set_column(at, "text", new)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join(fields))
