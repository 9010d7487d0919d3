"""Counting and ranking categories, and sessions within categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions import is_click
from footfall.operators.actions import category_events

TOP_N = 10

_MAP_SIDE_CUT = "spark.sql.optimizer.windowGroupLimitThreshold"
_SLICES = 64


def category_action_counts(events: DataFrame) -> DataFrame:
    """Tall form: ``category_id, kind, action_count``."""
    return events.groupBy("category_id", "kind").agg(
        F.count(F.lit(1)).alias("action_count")
    )


def category_counts(events: DataFrame) -> DataFrame:
    """Wide form: one row per category, zero where it has no such action."""
    return events.groupBy("category_id").agg(
        *[
            F.count_if(F.col("kind") == kind).alias(f"{kind}_count")
            for kind in ("click", "order", "pay")
        ]
    )


def category_counts_of_users(actions: DataFrame, user_ids: DataFrame) -> DataFrame:
    """The wide form over the given users' actions.

    Counted per user, category and kind first, so that the join moves counts and
    neither actions nor id lists. A user listed twice counts twice.
    """
    return merged_category_counts(
        category_user_counts(category_events(actions, "user_id")), user_ids
    )


def category_user_counts(events: DataFrame, *by: str) -> DataFrame:
    """``actions`` of each user, category and kind; ``by`` names further columns to keep apart."""
    return events.groupBy(*by, "user_id", "category_id", "kind").agg(
        F.count(F.lit(1)).alias("actions")
    )


def merged_category_counts(per_user: DataFrame, user_ids: DataFrame) -> DataFrame:
    """The wide form from users' counts, of the given users only."""
    return (
        per_user.join(user_ids, "user_id")
        .groupBy("category_id")
        .agg(
            *[
                F.sum(F.when(F.col("kind") == kind, F.col("actions")).otherwise(0)).alias(
                    f"{kind}_count"
                )
                for kind in ("click", "order", "pay")
            ]
        )
    )


def top_categories(counts: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n hottest by clicks, orders, payments; ties go by id."""
    return counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), "category_id"
    ).limit(n)


def clicks_in_categories(actions: DataFrame, top: DataFrame, *others: str) -> DataFrame:
    """``category_id, session_id`` and ``others`` of the clicks on a listed category.

    Written as IN over a subquery, the semi-join moves below any join the
    actions come from, which then carries no other rows. It needs no hint: the
    planner knows a limited list's size, and broadcasts it if that is small.
    What is no click is filtered at the files. Listed ids compare as numbers; one
    that no number prints as cannot have been clicked.
    """
    number = F.col("category_id").try_cast("bigint")
    listed = top.where(number.cast("string") == F.col("category_id")).select(number.alias("id"))
    clicked = F.col("click_category_id")
    return actions.where(is_click() & clicked.isin(listed)).select(
        clicked.cast("string").alias("category_id"), "session_id", *others
    )


def category_session_counts(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("category_id", "session_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def category_session_counts_of_users(
    actions: DataFrame, top: DataFrame, user_ids: DataFrame
) -> DataFrame:
    """Clicks per listed category and session of the given users.

    Counted per user first, so that the join moves one row a session and category.
    """
    per_user = (
        clicks_in_categories(actions, top, "user_id")
        .groupBy("user_id", "category_id", "session_id")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    return (
        per_user.join(user_ids, "user_id")
        .groupBy("category_id", "session_id")
        .agg(F.sum("clicks").alias("click_count"))
    )


def top_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group.

    The literal bound lets Spark cut every group to n rows inside each map
    task, so a hot group sends n rows per task, not all it has. Above the bound
    the session does that for, groups are cut in slices first, each a task of its own.
    """
    if n > int(df.sparkSession.conf.get(_MAP_SIDE_CUT, "1000")):
        sliced = df.withColumn("slice", F.pmod(F.xxhash64(*df.columns), F.lit(_SLICES)))
        df = _first_rows(sliced, [group, "slice"], order, n).drop("slice")
    return _first_rows(df, [group], order, n)


def _first_rows(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank")


def top_sessions(counts: DataFrame, n: int = TOP_N) -> DataFrame:
    """Each category's n sessions with the most clicks; ties go by session id."""
    return top_per_group(
        counts, "category_id", [F.desc("click_count"), F.asc("session_id")], n
    )
