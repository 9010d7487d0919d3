"""The four reports over filtered actions, each in its result table's columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from footfall.conditions import Conditions
from footfall.operators.actions import category_events
from footfall.operators.categories import (
    TOP_N,
    category_counts,
    category_counts_of_users,
    category_session_counts,
    category_session_counts_of_users,
    clicks_in_categories,
    top_categories,
    top_sessions,
)
from footfall.operators.pages import page_conversions
from footfall.operators.sampling import ROUNDED, SAMPLE_SIZE, SEED, stratified_sessions
from footfall.operators.sessions import session_buckets, session_ratios
from footfall.sources.sinks import stamp_run


def session_stats(sessions: DataFrame, conditions: Conditions, run_id: str) -> DataFrame:
    """One row: how many sessions, and what share is long or has many steps."""
    ratios = session_ratios(session_buckets(sessions))
    with_conditions = ratios.select(
        F.lit(conditions.to_json()).alias("condition_json"), *ratios.columns
    )
    return stamp_run(with_conditions, run_id, "task_id")


def session_extract(
    actions: DataFrame,
    run_id: str,
    sessions: DataFrame | None = None,
    sample_size: int = SAMPLE_SIZE,
    seed: int = SEED,
    allocation: str = ROUNDED,
) -> DataFrame:
    """About ``sample_size`` sessions, spread over start hours as all of them are.

    ``allocation`` is that of ``hour_quota``.
    """
    sample = stratified_sessions(actions, sessions, sample_size, seed, allocation)
    return stamp_run(
        sample.select(
            F.col("session_id").alias("sessionId"),
            F.col("start_time").alias("startTime"),
            F.col("step_length").alias("stepLength"),
            F.col("visit_length").alias("visitLength"),
            F.col("search_keywords").alias("searchKeyWords"),
            F.col("click_product_ids").alias("clickProductIds"),
            F.col("order_product_ids").alias("orderProductIds"),
            F.col("pay_product_ids").alias("payProductIds"),
        ),
        run_id,
    )


def category_top(
    actions: DataFrame, run_id: str, n: int = TOP_N, user_ids: DataFrame | None = None
) -> DataFrame:
    """The n hottest categories with their clicks, orders and payments.

    With ``user_ids``, of those users' actions, which are joined after counting.
    """
    if user_ids is None:
        counts = category_counts(category_events(actions))
    else:
        counts = category_counts_of_users(actions, user_ids)
    return stamp_run(top_categories(counts, n), run_id)


def category_session_top(
    actions: DataFrame,
    top: DataFrame,
    run_id: str,
    n: int = TOP_N,
    user_ids: DataFrame | None = None,
) -> DataFrame:
    """The n most active sessions in each category of ``top``; ``user_ids`` as above."""
    if user_ids is None:
        counts = category_session_counts(clicks_in_categories(actions, top))
    else:
        counts = category_session_counts_of_users(actions, top, user_ids)
    best = top_sessions(counts, n)
    return stamp_run(
        best.select(
            F.col("category_id").alias("categoryId"),
            F.col("session_id").alias("sessionId"),
            F.col("click_count").alias("clickCount"),
        ),
        run_id,
    )


def page_conversion(actions: DataFrame, flow: Sequence[int], run_id: str) -> DataFrame:
    """How many of each page's views in ``flow`` lead straight to the next page."""
    return stamp_run(page_conversions(actions, flow), run_id)
