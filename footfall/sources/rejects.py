"""Rows that do not meet the read contract, set aside with a reason instead of stopping a run.

The default is to raise: ``conform`` on a value that does not fit, the reports on a time
that is none. Here such rows get a reason each, the rest go on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType

from footfall.functions import is_unreadable, readable_moment
from footfall.schema import columns_of
from footfall.sources.sinks import Sink, stamp_run

REASON = "reason"
ROW = "row_json"
REJECTED_ACTIONS = "rejected_actions"


@dataclass(frozen=True)
class Counts:
    rows: int
    rejected: int


def _misfits(df: DataFrame, schema: StructType, times: tuple[str, ...]) -> Column:
    """The reasons against a row, in the schema's order, joined by "; "; NULL if there is none."""
    types = {field.name.lower(): field.dataType for field in df.schema}
    reasons = []
    for field in schema:
        own = F.col(field.name)
        if types[field.name.lower()] != field.dataType:
            misfit = own.isNotNull() & own.try_cast(field.dataType).isNull()
            reasons.append(F.when(misfit, f"{field.name} is no {field.dataType.simpleString()}"))
        if field.name in times:
            text = own.cast("string")
            unreadable = is_unreadable(text, readable_moment(text))
            reasons.append(F.when(unreadable, f"{field.name} is not yyyy-MM-dd HH:mm:ss"))
    return F.nullif(F.concat_ws("; ", *reasons), F.lit(""))


def judged(df: DataFrame, schema: StructType, times: tuple[str, ...] = ("action_time",)) -> DataFrame:
    """All rows of ``df`` with the column ``reason``: why a row breaks the contract, or NULL.

    Missing columns are an error as in ``conform``: no row could do without them.
    """
    columns_of(df, schema)
    return df.withColumn(REASON, _misfits(df, schema, times))


def accepted(df: DataFrame, schema: StructType, times: tuple[str, ...] = ("action_time",)) -> DataFrame:
    """What ``conform`` gives, without the rows that would raise there or in a report."""
    kept = judged(df, schema, times).where(F.col(REASON).isNull())
    return kept.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    )


def rejected(df: DataFrame, schema: StructType, times: tuple[str, ...] = ("action_time",)) -> DataFrame:
    """``reason, row_json``: the other rows, each as it came."""
    return _as_rows(judged(df, schema, times))


def _as_rows(all_rows: DataFrame) -> DataFrame:
    as_came = [c for c in all_rows.columns if c != REASON]
    row = F.to_json(F.struct(*as_came), {"ignoreNullFields": "false"})
    return all_rows.where(F.col(REASON).isNotNull()).select(REASON, row.alias(ROW))


def divert(
    df: DataFrame,
    schema: StructType,
    sink: Sink,
    run_id: str,
    table: str = REJECTED_ACTIONS,
    times: tuple[str, ...] = ("action_time",),
) -> Counts:
    """Hands the rejected rows to the sink; the same pass counts them and all rows."""
    seen = Observation(f"{table}-{run_id}")
    counted = judged(df, schema, times).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected"),
    )
    sink(stamp_run(_as_rows(counted), run_id), table)
    found = seen.get
    return Counts(found["rows"], found["rejected"])
