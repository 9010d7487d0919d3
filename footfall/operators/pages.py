"""How often one page directly follows another within a session.

A session's actions stand by time, then page; a page number that is null stands first
and is a page of no flow. An action's successor is the next one of its session, whatever
its page. Times are those of ``action_time``; unreadable ones raise an error, actions
without a time are their session's first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from footfall.functions import action_moment, epoch_seconds, percent

_SECONDS = 60


def page_successors(actions: DataFrame) -> DataFrame:
    """``page_id, next_page_id``: one row for each action, NULL after a session's last.

    Every minute of a session is ordered by itself, so a session with a large share of
    all actions is spread over as many tasks as it has minutes. Then the minutes'
    first and last pages, one row a minute, are put in order per session, and the last
    page of a minute is followed by the first of the next one that has any.
    """
    timed = actions.select("session_id", "page_id", action_moment(F.col("action_time")).alias("at"))
    minute = F.floor(epoch_seconds(F.col("at")) / _SECONDS)
    piece = Window.partitionBy("session_id", "minute").orderBy("at", "page_id")
    steps = timed.withColumn("minute", minute).select(
        "session_id",
        "minute",
        "page_id",
        F.lead("page_id").over(piece).alias("next_page_id"),
        F.lead(F.lit(1)).over(piece).isNull().alias("is_last"),
        (F.row_number().over(piece) == 1).alias("is_first"),
    )
    inner = steps.where(~F.col("is_last")).select("page_id", "next_page_id")
    # The window has dealt the rows by session and minute already: this moves none.
    ends = steps.groupBy("session_id", "minute").agg(
        F.max(F.when(F.col("is_first"), F.struct("page_id")))["page_id"].alias("first_page"),
        F.max(F.when(F.col("is_last"), F.struct("page_id")))["page_id"].alias("page_id"),
    )
    in_order = Window.partitionBy("session_id").orderBy("minute")
    across = ends.select("page_id", F.lead("first_page").over(in_order).alias("next_page_id"))
    return inner.unionByName(across)


def page_conversions(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """``step, from_page, to_page, views, conversions, conversion_rate`` for each step of ``flow``.

    ``views`` counts the actions on ``from_page``, ``conversions`` those of them that an
    action on ``to_page`` directly follows in the same session, and the rate is their
    share in percent with one decimal, NULL where nobody saw ``from_page``. Steps are
    numbered from 1, and a flow may come to a page again; a flow of fewer than two pages
    has no steps.
    """
    pages = F.lit(list(flow)).cast("array<bigint>")
    number = F.col("id").cast("int")
    wanted = actions.sparkSession.range(max(len(flow) - 1, 0)).select(
        (number + 1).alias("step"),
        F.get(pages, number).alias("from_page"),
        F.get(pages, number + 1).alias("to_page"),
    )
    counts = (
        page_successors(actions)
        .where(F.col("page_id").isin(list(flow[:-1])))
        .groupBy("page_id", "next_page_id")
        .agg(F.count(F.lit(1)).alias("actions"))
    )
    seen = F.col("page_id") == F.col("from_page")
    converted = F.when(F.col("next_page_id") == F.col("to_page"), F.col("actions"))
    return (
        wanted.join(counts, seen, "left")
        .groupBy("step", "from_page", "to_page")
        .agg(
            F.coalesce(F.sum("actions"), F.lit(0)).cast("bigint").alias("views"),
            F.coalesce(F.sum(converted), F.lit(0)).cast("bigint").alias("conversions"),
        )
        .withColumn("conversion_rate", percent(F.col("conversions"), F.col("views")))
    )
