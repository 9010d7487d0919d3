"""Page conversion against a walk over each session."""

import random
import re
from collections import Counter

import pytest
from builders import action, actions_frame, rows
from test_plans import plan

from footfall.conditions import Conditions
from footfall.operators.pages import page_conversions, page_successors
from footfall.plans import page_conversion, run_all
from footfall.schema import PAGE_CONVERT_RATE

from pyspark.sql import functions as F

DAY = "2018-11-26 "


def view(session_id, time, page, user_id=1):
    return action(session_id, user_id, DAY + time if time else "2018-11-26", page_id=page) | {
        "action_time": DAY + time if time else None
    }


def brute(actions, flow):
    sessions = {}
    for a in actions:
        sessions.setdefault(a["session_id"], []).append(a)
    views, pairs = Counter(), Counter()
    for own in sessions.values():
        own.sort(key=lambda a: (a["action_time"] or "", a["page_id"] is not None, a["page_id"] or 0))
        pages = [a["page_id"] for a in own]
        views.update(pages)
        pairs.update(zip(pages, pages[1:]))
    return [
        (
            i + 1, a, b, views[a], pairs[a, b],
            int(1000 * pairs[a, b] / views[a] + 0.5) / 10 if views[a] else None,
        )
        for i, (a, b) in enumerate(zip(flow, flow[1:]))
    ]


def test_worked_by_hand(spark):
    actions = [
        view("a", "09:59:58", 1), view("a", "10:00:01", 2), view("a", "10:00:01", 3),
        view("a", "10:07:00", 1), view("a", "10:07:01", 2),
        view("b", "10:00:00", 1), view("b", "10:00:05", 9), view("b", "10:00:06", 2),
        view("c", "10:00:00", 2),
    ]
    found = rows(page_conversions(actions_frame(spark, actions), (1, 2, 3, 4)))
    assert found == [(1, 1, 2, 3, 2, 66.7), (2, 2, 3, 4, 1, 25.0), (3, 3, 4, 1, 0, 0.0)]
    assert found == brute(actions, (1, 2, 3, 4))


@pytest.mark.parametrize("seed", range(3))
def test_against_walking(spark, seed):
    rng = random.Random(seed)
    ids = ["a", "b", "c", None, ""]
    times = [None, *[f"{10 + rng.randrange(2)}:{rng.randrange(4):02d}:{rng.randrange(5):02d}" for _ in range(40)]]
    actions = [
        view(rng.choice(ids), rng.choice(times), rng.choice([1, 2, 3, 4, None])) for _ in range(400)
    ]
    flow = (1, 2, 1, 1, 3, 8, 4)
    frame = actions_frame(spark, actions).repartition(5)
    assert rows(page_conversions(frame, flow)) == brute(actions, flow)
    assert page_successors(frame).count() == len(actions)


def test_flows_without_steps_and_no_actions(spark):
    one = actions_frame(spark, [view("a", "10:00:00", 1)])
    assert rows(page_conversions(one, ())) == [] and rows(page_conversions(one, (1,))) == []
    none = actions_frame(spark, [])
    assert rows(page_conversions(none, (1, 2))) == [(1, 1, 2, 0, 0, None)]


def test_unreadable_times_raise(spark):
    bad = actions_frame(spark, [{**view("a", "10:00:00", 1), "action_time": "nonsense"}])
    with pytest.raises(Exception, match="action_time is not"):
        page_conversions(bad, (1, 2)).collect()


def test_a_session_of_most_actions_is_spread_over_its_minutes(spark):
    """Half a million actions of one session: no task sorts more than some minutes of it."""
    actions = spark.range(0, 500_000, 1, 8).select(
        F.expr("concat('bot', id div 1000000)").alias("session_id"),
        (F.col("id") % 7).alias("page_id"),
        F.expr("string(timestamp_ntz'2018-11-26 00:00:00' + make_dt_interval(0, 0, 0, id div 6))").alias("action_time"),
    )
    flow = (1, 2, 3)
    found = rows(page_conversions(actions, flow))
    # Six actions a second stand by page there, so steps within a second go up by one or two.
    seconds = {}
    for i in range(500_000):
        seconds.setdefault(i // 6, []).append(i % 7)
    pages = [p for s in sorted(seconds) for p in sorted(seconds[s])]
    views, pairs = Counter(pages), Counter(zip(pages, pages[1:]))
    assert [(r[3], r[4]) for r in found] == [(views[a], pairs[a, b]) for a, b in ((1, 2), (2, 3))]
    text = plan(page_successors(actions))
    assert re.search(r"hashpartitioning\(session_id#\d+, minute#\d+L", text)
    # Grouping the minutes moves nothing: both sides deal by minute, and one orders minutes.
    assert text.count("Exchange hashpartitioning") == 3


def test_conditions_name_the_flow(spark):
    for value in ("1,2, 3", [1, 2, 3], ["1", 2.0, "3"]):
        assert Conditions.from_dict({"targetPageFlow": value}).page_flow == (1, 2, 3)
    for value in (None, "", " ", [], ","):
        assert Conditions.from_dict({"targetPageFlow": value}) == Conditions()
    with pytest.raises(ValueError, match="targetPageFlow"):
        Conditions.from_dict({"targetPageFlow": "1,x"})
    assert Conditions(page_flow=(1, 2)).to_json() == '{"targetPageFlow": [1, 2]}'


def test_run_delivers_it_if_asked(spark):
    from builders import worked_actions, worked_users

    found = {}
    run_all(
        worked_actions(spark), worked_users(spark), Conditions(page_flow=(1, 1)),
        lambda frame, table: found.update({table: frame.collect(), table + "_schema": frame.schema}), "r",
    )
    assert [tuple(r) for r in found["page_convert_rate"]] == [("r", 1, 1, 1, 12, 7, 58.3)]
    names = [(f.name, f.dataType) for f in found["page_convert_rate_schema"]]
    assert names == [(f.name, f.dataType) for f in PAGE_CONVERT_RATE]
    stamped = page_conversion(worked_actions(spark), (1, 1), "r")
    assert stamped.columns == PAGE_CONVERT_RATE.names
