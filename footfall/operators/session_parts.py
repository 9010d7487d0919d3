"""Sessions whose lists need not fit one row.

``session_info`` joins all of a session's searches and products into one row, which for
the session of all rows without an id, or for a robot's, may be more than a row can be.
Here the same lists come in numbered parts of bounded length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions import action_moment, epoch_seconds
from footfall.operators.actions import product_events

PART_CHARACTERS = 1 << 20
_KEYS = ("session_id", "kind")


def session_info_parts(actions: DataFrame, characters: int = PART_CHARACTERS) -> DataFrame:
    """``session_id, kind, part, first_entry, entries, list_part``, parts numbered from 0.

    ``kind`` is keyword, click, order or pay. The parts of a session and kind, joined by
    commas in their order, are that list of ``session_info``. ``first_entry`` is the place
    of a part's first value in the whole list, from 0. A part ends with the value that
    reaches ``characters``, commas counted, so it is longer than that by one value at
    most. A session without values of a kind has no part of it.

    Where a value stands is found without any task seeing its whole session: the values
    of one minute are numbered in that minute, the minutes' totals, one row a minute, are
    added up in order, and both together tell the part. Only a part's own values are
    ever collected.
    """
    timed = (
        product_events(actions)
        .where(F.col("kind").isNotNull())
        .withColumn("at", action_moment(F.col("action_time")))
        .withColumn("minute", F.floor(epoch_seconds(F.col("at")) / 60))
    )
    width = (F.char_length("value") + 1).cast("bigint")
    own_minute = Window.partitionBy(*_KEYS, "minute").orderBy("at", "value")
    before = own_minute.rowsBetween(Window.unboundedPreceding, -1)
    numbered = timed.select(
        *_KEYS,
        "minute",
        "at",
        "value",
        (F.row_number().over(own_minute) - 1).alias("place"),
        F.coalesce(F.sum(width).over(before), F.lit(0)).alias("offset"),
    )
    minutes = timed.groupBy(*_KEYS, "minute").agg(
        F.count(F.lit(1)).alias("entries"), F.sum(width).alias("width")
    )
    earlier = Window.partitionBy(*_KEYS).orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    begins = minutes.select(
        *[F.col(c).alias(f"_{c}") for c in (*_KEYS, "minute")],
        F.coalesce(F.sum("entries").over(earlier), F.lit(0)).alias("entries_before"),
        F.coalesce(F.sum("width").over(earlier), F.lit(0)).alias("width_before"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*_KEYS, "minute")]
    placed = numbered.join(begins, same).select(
        *_KEYS,
        (F.col("entries_before") + F.col("place")).alias("entry"),
        F.floor((F.col("width_before") + F.col("offset")) / characters).cast("bigint").alias("part"),
        "value",
    )
    parts = placed.groupBy(*_KEYS, "part").agg(
        F.min("entry").alias("first_entry"),
        F.count(F.lit(1)).alias("entries"),
        _joined(F.sort_array(F.collect_list(F.struct("entry", "value")))).alias("list_part"),
    )
    return _renumbered(parts)


def _joined(entries: Column) -> Column:
    return F.array_join(F.transform(entries, lambda e: e["value"]), ",")


def _renumbered(parts: DataFrame) -> DataFrame:
    """A value longer than a part leaves numbers out; parts are few, so they are counted anew."""
    in_order = Window.partitionBy(*_KEYS).orderBy("part")
    number = (F.row_number().over(in_order) - 1).cast("bigint")
    return parts.withColumn("part", number).select(
        *_KEYS, "part", "first_entry", "entries", "list_part"
    )
