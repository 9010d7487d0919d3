"""What each day adds to the reports, stored so that a new day reads only itself.

A day's state holds, for each user, the bounds of the sessions that had actions on that
day and the counts of the categories touched. States of any days merge into what the
actions of all those days give: a session over midnight has two bounds, which become
one. Users stay apart in a state, so one state serves any conditions on users.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from footfall.conditions import Conditions
from footfall.operators.actions import category_events
from footfall.operators.categories import category_user_counts, merged_category_counts
from footfall.operators.sessions import merged_rollup, session_bounds
from footfall.sources.days import DAY, write_days


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


SESSION_STATE = _struct(
    ("user_id", LongType()),
    ("session_id", StringType()),
    ("first_at", TimestampNTZType()),
    ("last_at", TimestampNTZType()),
    ("step_length", LongType()),
    ("unreadable", LongType()),
    (DAY, StringType()),
)
CATEGORY_STATE = _struct(
    ("user_id", LongType()),
    ("category_id", StringType()),
    ("kind", StringType()),
    ("actions", LongType()),
    (DAY, StringType()),
)


def day_session_bounds(actions: DataFrame) -> DataFrame:
    """Bounds of each day's part of each user's sessions."""
    return session_bounds(actions, DAY, "user_id").select(*SESSION_STATE.names)


def day_category_counts(actions: DataFrame) -> DataFrame:
    """Actions of each day by user, category and kind."""
    return category_user_counts(category_events(actions, DAY, "user_id"), DAY).select(
        *CATEGORY_STATE.names
    )


class DayStates:
    """The states below ``folder``: one part for sessions and one for categories, by day."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._sessions = f"{folder.rstrip('/')}/sessions"
        self._categories = f"{folder.rstrip('/')}/categories"

    def add(self, actions: DataFrame, days: Iterable[str] | None = None) -> None:
        """Compute the states of the frame's days anew, or of the ``days`` named only.

        The rows have to be all that those days have. Doing it again changes nothing.
        """
        if days is not None:
            actions = actions.where(F.col(DAY).isin(list(days)))
        write_days(day_session_bounds(actions), self._sessions)
        write_days(day_category_counts(actions), self._categories)

    def sessions(self, conditions: Conditions, user_ids: DataFrame) -> DataFrame:
        """``session_rollup`` of the actions of the days in range, from their states alone."""
        states = self._spark.read.schema(SESSION_STATE).parquet(self._sessions)
        return merged_rollup(states.where(conditions.on_actions()), user_ids)

    def category_counts(self, conditions: Conditions, user_ids: DataFrame) -> DataFrame:
        """``category_counts_of_users`` of the days in range, from their states alone."""
        states = self._spark.read.schema(CATEGORY_STATE).parquet(self._categories)
        return merged_category_counts(states.where(conditions.on_actions()), user_ids)
