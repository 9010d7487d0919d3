"""Rows that break the contract are set aside, counted, and the rest goes on."""

import json

import pytest
from builders import actions_frame, click, rows, users_frame

from footfall.conditions import Conditions
from footfall.plans import run_all
from footfall.schema import USER_VISIT_ACTION, conform
from footfall.sources.rejects import accepted, divert, judged, rejected

from pyspark.sql import functions as F

NOON = "2018-11-26 12:00:00"


@pytest.fixture
def loose(spark):
    """Five actions; pages and cities come as text, one row has an extra column's value."""
    good = actions_frame(spark, [click(s, 1, NOON, 3) for s in "abcde"])
    own = F.col("session_id")
    return good.select(
        *[c for c in good.columns if c not in ("page_id", "action_time", "city_id")],
        F.when(own == "b", "x9").when(own == "c", F.lit(None)).otherwise("7").alias("page_id"),
        F.when(own == "d", "at noon").when(own == "b", "").otherwise(NOON).alias("action_time"),
        F.when(own == "e", "99999999999999999999").otherwise("1").alias("city_id"),
        F.lit("kept").alias("extra"),
    )


def test_reasons(loose):
    reasons = dict(rows(judged(loose, USER_VISIT_ACTION).select("session_id", "reason")))
    assert reasons == {
        "a": None,
        "b": "page_id is no bigint; action_time is not yyyy-MM-dd HH:mm:ss",
        "c": None,
        "d": "action_time is not yyyy-MM-dd HH:mm:ss",
        "e": "city_id is no bigint",
    }


def test_accepted_rows_are_those_of_the_contract(loose):
    kept = accepted(loose, USER_VISIT_ACTION)
    assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in USER_VISIT_ACTION]
    fine = loose.where("session_id IN ('a', 'c')")
    assert rows(kept) == rows(conform(fine, USER_VISIT_ACTION))
    with pytest.raises(Exception, match="CAST"):
        conform(loose, USER_VISIT_ACTION).collect()
    with pytest.raises(ValueError, match="page_id"):
        accepted(loose.drop("page_id"), USER_VISIT_ACTION)


def test_rejected_rows_are_kept_as_they_came(loose):
    found = {json.loads(r.row_json)["session_id"]: json.loads(r.row_json) for r in rejected(loose, USER_VISIT_ACTION).collect()}
    assert set(found) == {"b", "d", "e"}
    assert found["b"]["page_id"] == "x9" and found["b"]["extra"] == "kept"
    assert found["d"]["search_keyword"] is None and list(found["d"]) == loose.columns


def test_one_pass_writes_and_counts(loose):
    passes = loose.sparkSession.sparkContext.accumulator(0)
    delivered = {}

    def sink(frame, table):
        passes.add(1)
        delivered[table] = rows(frame)

    counts = divert(loose, USER_VISIT_ACTION, sink, "r")
    assert (counts.rows, counts.rejected) == (5, 3)
    assert passes.value == 1
    assert [r[0] for r in delivered["rejected_actions"]] == ["r"] * 3


def test_nothing_rejected_and_no_rows(spark):
    for n in (0, 3):
        frame = actions_frame(spark, [click("a", 1, NOON, 1)] * n)
        counts = divert(frame, USER_VISIT_ACTION, lambda f, t: f.collect(), "r")
        assert (counts.rows, counts.rejected) == (n, 0)
        assert rows(accepted(frame, USER_VISIT_ACTION)) == rows(frame)


def test_a_run_goes_on_without_them(spark, loose):
    delivered = {}

    def sink(frame, table):
        delivered[table] = rows(frame)

    users = users_frame(spark, [(1, 30, "a")])
    run_all(loose, users, Conditions(), sink, "r", on_rejected="divert")
    assert list(delivered)[0] == "rejected_actions" and len(delivered["rejected_actions"]) == 3
    assert delivered["session_stat_info"][0][2] == 2
    with pytest.raises(Exception):
        run_all(loose, users, Conditions(), sink, "r2")
    with pytest.raises(ValueError, match="on_rejected"):
        run_all(loose, users, Conditions(), sink, "r3", on_rejected="skip")
