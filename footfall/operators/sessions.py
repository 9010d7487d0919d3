"""Rolling actions up into sessions. A session is one ``session_id``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions import (
    action_moment,
    day_hour,
    epoch_seconds,
    is_unreadable,
    moment_text,
    percent,
    readable_moment,
    seconds_between,
    unreadable_error,
)
from footfall.operators.actions import product_events

LONG_VISIT_MS = 10_000
LONG_STEPS = 5

# List kinds and the session columns that hold them.
_LISTS = {
    "keyword": "search_keywords",
    "click": "click_product_ids",
    "order": "order_product_ids",
    "pay": "pay_product_ids",
}


def session_bounds(actions: DataFrame, *by: str) -> DataFrame:
    """``session_id, first_at, last_at, step_length, unreadable``; the times are zone-free.

    ``by`` names further columns to keep apart, see ``merge_bounds``. Everything
    combines map-side, so even a session with a large share of all rows
    shuffles one row per task. Unreadable times are only counted here: they may
    be those of a user that is not asked for.
    """
    at = readable_moment(F.col("action_time"))
    no_time = is_unreadable(F.col("action_time"), F.col("at"))
    return (
        actions.select(*by, "session_id", "action_time", at.alias("at"))
        .groupBy(*by, "session_id")
        .agg(
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
            F.count(F.lit(1)).alias("step_length"),
            F.count_if(no_time).alias("unreadable"),
        )
    )


def merge_bounds(parts: DataFrame, *others: Column) -> DataFrame:
    """Bounds of parts of sessions, put together per session."""
    return parts.groupBy("session_id").agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.sum("step_length").alias("step_length"),
        F.sum("unreadable").alias("unreadable"),
        *others,
    )


def session_rollup(actions: DataFrame, user_ids: DataFrame | None = None) -> DataFrame:
    """``session_id, start_time, day_hour, visit_length, step_length``.

    Lengths are in milliseconds and in rows. With ``user_ids``, only those users'
    actions count: rows are combined per user and session before that join, so
    what it moves is about one row per session instead of one per action. Only
    times of users that are left raise an error if they are unreadable.
    """
    if user_ids is None:
        return _with_times(session_bounds(actions))
    return merged_rollup(session_bounds(actions, "user_id"), user_ids)


def merged_rollup(parts: DataFrame, user_ids: DataFrame) -> DataFrame:
    """The roll-up from bounds of users' parts of sessions, of the given users only."""
    return _with_times(merge_bounds(parts.join(user_ids, "user_id")))


def _with_times(bounds: DataFrame, *others: Column) -> DataFrame:
    first_at = F.when(F.col("unreadable") > 0, unreadable_error()).otherwise(F.col("first_at"))
    start_time = moment_text(first_at)
    seconds = seconds_between(F.col("last_at"), F.col("first_at"))
    return bounds.select(
        "session_id",
        start_time.alias("start_time"),
        day_hour(start_time).alias("day_hour"),
        (seconds * 1000).alias("visit_length"),
        "step_length",
        *others,
    )


def visit_bucket(long_visit_ms: int = LONG_VISIT_MS) -> Column:
    return F.when(F.col("visit_length") > long_visit_ms, "gt").otherwise("le")


def step_bucket(long_steps: int = LONG_STEPS) -> Column:
    return F.when(F.col("step_length") > long_steps, "gt").otherwise("le")


def session_info(actions: DataFrame) -> DataFrame:
    """The roll-up plus four comma-joined lists, ordered by time, then value.

    The lists are built per session and minute first and joined per session
    after, so sorting a very long session is spread over many tasks and only
    the finished text, which has to fit one row anyway, meets in one.
    """
    entry = F.when(F.col("kind").isNotNull(), F.struct("at", "value", "kind"))
    minutes = (
        product_events(actions)
        .withColumn("at", action_moment(F.col("action_time")))
        .select(
            "session_id",
            F.floor(epoch_seconds(F.col("at")) / 60).alias("minute"),
            "at",
            entry.alias("entry"),
        )
        .groupBy("session_id", "minute")
        .agg(
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
            F.count(F.lit(1)).alias("step_length"),
            F.lit(0).cast("long").alias("unreadable"),
            F.sort_array(F.collect_list("entry")).alias("entries"),
        )
    )
    pieces = minutes.select(
        "*", *[_piece(kind).alias(name) for kind, name in _LISTS.items()]
    ).drop("entries")
    piece = F.struct("minute", *_LISTS.values())
    whole = merge_bounds(pieces, F.sort_array(F.collect_list(piece)).alias("pieces"))
    return _with_times(whole, *[_join_pieces(name).alias(name) for name in _LISTS.values()])


def _piece(kind: str) -> Column:
    """One kind's values of a minute, joined; NULL if it has none."""
    return F.expr(
        f"CASE WHEN exists(entries, e -> e.kind = '{kind}') THEN"
        f" array_join(filter(entries, e -> e.kind = '{kind}').value, ',') END"
    )


def _join_pieces(name: str) -> Column:
    """A session's pieces in time order; minutes without the kind drop out."""
    return F.array_join(F.col("pieces")[name], ",")


def session_buckets(
    sessions: DataFrame,
    long_visit_ms: int = LONG_VISIT_MS,
    long_steps: int = LONG_STEPS,
) -> DataFrame:
    """One row: the session count and how many fall in each of four buckets."""
    visit, steps = visit_bucket(long_visit_ms), step_bucket(long_steps)
    return sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        F.count_if(visit == "gt").alias("visit_length_gt_10_count"),
        F.count_if(visit == "le").alias("visit_length_le_10_count"),
        F.count_if(steps == "gt").alias("step_length_gt_5_count"),
        F.count_if(steps == "le").alias("step_length_le_5_count"),
    )


def session_ratios(buckets: DataFrame) -> DataFrame:
    """The bucket counts as percentages; NULL when there is no session."""
    total = F.col("session_count")
    return buckets.select(
        "session_count",
        *[
            percent(F.col(f"{bucket}_count"), total).alias(f"{bucket}_ratio")
            for bucket in (
                "visit_length_gt_10",
                "visit_length_le_10",
                "step_length_gt_5",
                "step_length_le_5",
            )
        ],
    )


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("day_hour").agg(F.count(F.lit(1)).alias("session_count"))
