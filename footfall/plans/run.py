"""One run: filter once, compute the reports, deliver each as it is done."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from footfall.conditions import Conditions
from footfall.operators.actions import actions_of_users, matching_users
from footfall.operators.categories import TOP_N
from footfall.operators.membership import (
    MOST_BYTES,
    exact_filter,
    exact_length,
    filter_length,
    id_filter,
    is_in,
    may_be_in,
)
from footfall.operators.sampling import ROUNDED, SAMPLE_SIZE, SEED
from footfall.operators.sessions import session_rollup
from footfall.plans.manifest import Manifest, Unrecorded, written
from footfall.plans.reports import (
    category_session_top,
    category_top,
    page_conversion,
    session_extract,
    session_stats,
)
from footfall.plans.scratch import Scratch
from footfall.schema import USER_VISIT_ACTION
from footfall.sources.rejects import REJECTED_ACTIONS, accepted, rejected
from footfall.sources.sinks import Sink, stamp_run

RAISE, DIVERT = "raise", "divert"


def of_users(
    actions: DataFrame, user_ids: DataFrame, tables: Scratch, most_bytes: int = MOST_BYTES
) -> tuple[DataFrame, DataFrame | None]:
    """Actions of ``user_ids``, a written table, and the ids that are still to be joined to them.

    Ids that lie close enough together become a filter of one bit each: what passes it is
    exactly those users' actions, and nothing is left to join unless a user is listed
    twice. Others become a filter that a few other users pass, and the join decides; it
    saves counting and shuffling most of what the join would drop. With more ids than a
    filter of ``most_bytes`` can tell apart, all actions go on to the join.
    """
    ids, least, most = user_ids.agg(
        F.count("user_id"), F.min("user_id"), F.max("user_id")
    ).first()
    if not ids:
        return actions.where(F.lit(False)), None
    user_id, name = F.col("user_id"), "user_filter"
    length = exact_length(least, most, most_bytes)
    if length is not None:
        found = written(tables, lambda: exact_filter(user_ids, "user_id", least, length), name)
        words = found.select("words").scalar()
        kept = actions.where(is_in(words, user_id, least, most))
        listed_once = found.select("bits_set").first()[0] == ids
        return kept, None if listed_once else user_ids
    length = filter_length(ids, most_bytes=most_bytes)
    if length is None:
        return actions, user_ids
    found = written(tables, lambda: id_filter(user_ids, "user_id", length), name)
    return actions.where(may_be_in(found.select("words").scalar(), user_id)), user_ids


def run_all(
    actions: DataFrame,
    users: DataFrame,
    conditions: Conditions,
    sink: Sink,
    run_id: str | None = None,
    sample_size: int = SAMPLE_SIZE,
    top_n: int = TOP_N,
    sessions_per_category: int = TOP_N,
    seed: int = SEED,
    allocation: str = ROUNDED,
    resumable: bool = False,
    on_rejected: str = RAISE,
) -> str:
    """Compute and deliver all reports in order; returns the run's id.

    What several reports need is written once: the ids of the matching users, a filter
    over them, the session roll-up (statistics and sample) and the top categories (their
    report and the sessions within them). The filtered actions themselves are
    as large as the input, so each report scans just the columns it reads. The filter
    drops other users' actions at the scan. Where it is not exact, all but the sample's
    lists count per user before the user join; how that join runs is left to the planner,
    which knows the written ids' size.

    A ``resumable`` run needs a ``run_id``. If it fails, a second call with that id and
    the same settings and inputs delivers only what the first did not, and computes
    nothing again that the first had written. After the last delivery such calls do
    nothing. A sink that fails halfway is called again with the same rows: sinks that
    know a run's rows (``append_table``, ``folder_sink``) then deliver each once.

    Actions that break the read contract raise an error; with ``on_rejected="divert"``
    they are delivered first, as ``rejected_actions``, and the reports do without them.
    ``actions`` may then be a table as it came, whose columns need not have their types.
    """
    if on_rejected not in (RAISE, DIVERT):
        raise ValueError(f"on_rejected is {RAISE} or {DIVERT}, not {on_rejected}")
    if resumable and not run_id:
        raise ValueError("a resumable run needs a run id")
    run_id = run_id or str(uuid.uuid4())
    spark = actions.sparkSession
    if resumable:
        options = (sample_size, top_n, sessions_per_category, seed, allocation, on_rejected)
        run = Manifest(spark, run_id, {"conditions": conditions, "options": options})
    else:
        run = Unrecorded(spark, run_id)
    steps: dict[str, Callable[[], DataFrame]] = {}
    if on_rejected == DIVERT:
        loose = actions
        steps[REJECTED_ACTIONS] = lambda: stamp_run(rejected(loose, USER_VISIT_ACTION), run_id)
        actions = accepted(loose, USER_VISIT_ACTION)
    reports = Reports(actions, users, conditions, run.tables, run_id)
    steps |= {
        "session_stat_info": reports.stats,
        "random_session_info": lambda: reports.extract(sample_size, seed, allocation),
        "category_top10": lambda: reports.top(top_n),
        "category_top10_session_count": lambda: reports.top_sessions(top_n, sessions_per_category),
    }
    if conditions.page_flow:
        steps["page_convert_rate"] = reports.pages
    try:
        for table, build in steps.items():
            run.deliver(build, sink, table)
    except BaseException:
        if not resumable:
            run.finish()
        raise
    run.finish()
    return run_id


class Reports:
    """A run's reports, and what they share: written when the first one asks for it."""

    def __init__(
        self,
        actions: DataFrame,
        users: DataFrame,
        conditions: Conditions,
        tables: Scratch,
        run_id: str,
    ) -> None:
        self._actions, self._users, self._conditions = actions, users, conditions
        self._tables, self._run_id = tables, run_id
        self._matched: tuple[DataFrame, DataFrame | None] | None = None

    def _user_ids(self) -> DataFrame:
        ids = lambda: matching_users(self._users, self._conditions)
        return written(self._tables, ids, "users")

    def _matching(self) -> tuple[DataFrame, DataFrame | None]:
        """Actions in range of the matching users, as ``of_users`` gives them."""
        if self._matched is None:
            in_range = self._actions.where(self._conditions.on_actions())
            self._matched = of_users(in_range, self._user_ids(), self._tables)
        return self._matched

    def _joined(self) -> DataFrame:
        actions, user_ids = self._matching()
        if user_ids is None:
            return actions
        return actions_of_users(actions, user_ids, self._conditions)

    def _sessions(self) -> DataFrame:
        return written(self._tables, lambda: session_rollup(*self._matching()), "sessions")

    def _top(self, n: int) -> DataFrame:
        def build() -> DataFrame:
            actions, user_ids = self._matching()
            return category_top(actions, self._run_id, n, user_ids)

        return written(self._tables, build, "top_categories")

    def stats(self) -> DataFrame:
        return session_stats(self._sessions(), self._conditions, self._run_id)

    def extract(self, size: int, seed: int, allocation: str) -> DataFrame:
        return session_extract(
            self._joined(), self._run_id, self._sessions(), size, seed, allocation
        )

    def top(self, n: int) -> DataFrame:
        return self._top(n)

    def top_sessions(self, n: int, per_category: int) -> DataFrame:
        actions, user_ids = self._matching()
        return category_session_top(actions, self._top(n), self._run_id, per_category, user_ids)

    def pages(self) -> DataFrame:
        return page_conversion(self._joined(), self._conditions.page_flow, self._run_id)
