"""Actions of the users and days a run asks for, and what they count towards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.conditions import Conditions
from footfall.functions import category_ids, category_kind, product_kind, product_value


def matching_users(users: DataFrame, conditions: Conditions) -> DataFrame:
    """Ids of the users that meet the conditions; duplicates are kept."""
    return users.where(conditions.on_users()).select("user_id")


def actions_of_users(
    actions: DataFrame, user_ids: DataFrame, conditions: Conditions
) -> DataFrame:
    """Actions in the date range joined to the given users; action columns only.

    No strategy is forced. The planner broadcasts the ids if their size allows
    and else shuffles both sides on ``user_id``; a user with a huge share of
    the rows is then split by the adaptive skew join, which is free to do so
    because every report regroups by another key.
    """
    in_range = actions.where(conditions.on_actions())
    return in_range.join(user_ids, "user_id", "inner").select(*actions.columns)


def filtered_actions(
    actions: DataFrame, users: DataFrame, conditions: Conditions
) -> DataFrame:
    return actions_of_users(actions, matching_users(users, conditions), conditions)


def category_events(actions: DataFrame, *others: str) -> DataFrame:
    """One row per (action, category): ``session_id, kind, category_id`` and ``others``.

    A list that names a category twice counts it twice. Actions without a kind
    are dropped by a filter of its own, which moves below a join.
    """
    return actions.where(category_kind().isNotNull()).select(
        *others,
        "session_id",
        category_kind().alias("kind"),
        F.explode(category_ids()).alias("category_id"),
    )


def product_events(actions: DataFrame) -> DataFrame:
    """Every action with its list kind and the text it adds, if any."""
    return actions.select(
        "session_id",
        "action_time",
        product_kind().alias("kind"),
        product_value().alias("value"),
    )
